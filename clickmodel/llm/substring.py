"""Substring dedup with fixed-block anchors.

A repeat is a run of at least ``window`` words that also stands in a document with a smaller id.
Every document is cut into non-overlapping blocks of ``block`` words, at most half a window, so
each window of a document holds a whole block of it. The blocks' fingerprints are the index.
Every rolling run of ``block`` words of every document probes it. Around each hit, the windows
that hold the hit are compared by fingerprint across documents: those found in a document with a
smaller id are covered, and runs of covered windows are the maximal exact repeats. Copies of a
whole text go past the anchors: all their windows are covered by the least id that has the text.

Fingerprints travel packed: one row per batch of documents and part of the fingerprint space,
with the documents' ids, counts and fingerprints as binary columns. The index and the probes of
a part meet in one task; the index (a word in ``block``) is held, the probes stream past it.
Texts are dealt out by id once, and that exchange serves both joins.

Windows are judged on the input. Block fingerprints have 32 bits besides the part, and only
choose what is compared; windows are compared by 64-bit fingerprints.

Defined results: NULL and empty texts have no words; a document with a NULL id keeps all its
words and covers nothing; rows that repeat an id are judged apart and never cover each other;
texts under ``window`` words keep all; an empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch
from clickmodel.llm.hashing import Words
from clickmodel.llm.packed import CELLS, HITS, cells, gather, unpack

WINDOW, BLOCK = 50, 25
BATCH_TEXTS = 2000  # texts hashed at a time


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, BATCH_TEXTS):
        yield batch.slice(a, BATCH_TEXTS)


def _least(ids: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints, sorted, with the least id that has each."""
    order = np.lexsort((ids, prints))
    ids, prints = ids[order], prints[order]
    first = np.r_[True, prints[1:] != prints[:-1]] if len(prints) else np.zeros(0, bool)
    return prints[first], ids[first]


def _anchor_cells(parts: int, window: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole):
                words, ids = Words(b.column("text")), b.column("_id").to_numpy()
                prints, at = words.runs(block)
                doc = words.text_of(at)
                long = words.counts[doc] >= window
                prints, at, doc = prints[long], at[long], doc[long]
                if not len(at):
                    continue
                anchor = (at - words.first[doc]) % block == 0
                yield cells(ids[doc[anchor]], prints[anchor], parts, 0, False)
                yield cells(ids[doc], prints, parts, 1, False)

    return run


def _probe(parts: int):
    """Streams the probes of a part past its index; rows come sorted by (part, kind).

    A probe hits when a smaller id has the block; the least owner of a block that was hit is
    reported as well, as its windows are what the others are compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, index, owners, touched, found = None, [], None, None, None, []

        def close():
            if index is not None and touched.any():
                found.append((owners[touched], index[touched]))
            if found:
                ids, prints = (np.concatenate(x) for x in zip(*found, strict=True))
                yield cells(ids, (np.uint64(part) << np.uint64(32)) | prints.astype(np.uint64), parts, 0, True, by_id=True)

        for b in batches:
            for row in b.to_pylist():
                if row["part"] != part:
                    yield from close()
                    part, blocks, index, found = row["part"], [], None, []
                ids, prints = unpack(row, False)
                if row["kind"] == 0:
                    blocks.append((ids, prints))
                    continue
                if index is None:
                    none = [(np.zeros(0, np.int64), np.zeros(0, np.uint32))]
                    index, owners = _least(*(np.concatenate(x) for x in zip(*(blocks or none), strict=True)))
                    touched, blocks = np.zeros(len(index), bool), []
                if not len(index):
                    continue
                k = np.minimum(np.searchsorted(index, prints), len(index) - 1)
                hit = (index[k] == prints) & (owners[k] < ids)
                if hit.any():
                    touched[k[hit]] = True
                    found.append((ids[hit], prints[hit]))
        yield from close()

    return run


def _window_cells(parts: int, window: int, block: int):
    """The distinct fingerprints of the windows around each document's hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole):
                words, ids, hits = Words(b.column("text")), b.column("_id").to_numpy(), b.column("hits")
                runs, at = words.runs(block)
                keys = (((runs >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (runs & np.uint64(0xFFFFFFFF))
                near = np.zeros(len(words.hashes) + 1, np.int32)  # a hit at word j lies in the windows that begin at j - (window - block) to j
                cut = np.searchsorted(at, words.first)
                for k in range(b.num_rows):
                    a, e = cut[k], cut[k + 1]
                    if a < e and words.counts[k] >= window:
                        own = np.frombuffer(hits[k].as_py(), np.uint64)
                        j = at[a:e][np.isin(keys[a:e], own)]
                        np.add.at(near, np.maximum(j - (window - block), words.first[k]), 1)
                        np.add.at(near, j + 1, -1)
                wide, start = words.runs(window)
                chosen = np.cumsum(near)[start] > 0
                if chosen.any():
                    doc, prints = ids[words.text_of(start[chosen])], wide[chosen]
                    order = np.lexsort((prints, doc))
                    doc, prints = doc[order], prints[order]
                    first = np.r_[True, (doc[1:] != doc[:-1]) | (prints[1:] != prints[:-1])]
                    yield cells(doc[first], prints[first], parts, 0, True)

    return run


def _covered(parts: int):
    """Of each part's window fingerprints, those that a smaller id has too, per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def close():
            if held:
                ids, prints = (np.concatenate(x) for x in zip(*held, strict=True))
                index, owners = _least(ids, prints)
                later = owners[np.searchsorted(index, prints)] < ids
                if later.any():
                    yield cells(ids[later], prints[later], parts, 0, True, by_id=True)

        for b in batches:
            for row in b.to_pylist():
                if row["part"] != part:
                    yield from close()
                    part, held = row["part"], []
                held.append(unpack(row, True))
        yield from close()

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(window: int):
    """Word ranges covered by repeats, counts, and the words that stay, of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole):
                words = Words(b.column("text"))
                wide, start = words.runs(window)
                cut = np.searchsorted(start, words.first)
                removed, spans, kept = [], [], []
                for k, prints in enumerate(b.column("covered")):
                    n = int(words.counts[k])
                    gone = np.zeros(n + 1, np.int32)
                    if prints.is_valid or b.column("copy")[k].as_py():
                        a, e = cut[k], cut[k + 1]
                        if b.column("copy")[k].as_py():
                            s = start[a:e] - words.first[k]
                        else:
                            own = np.frombuffer(prints.as_py(), np.uint64)
                            s = start[a:e][np.isin(wide[a:e], own)] - words.first[k]
                        gone[s] += 1
                        np.add.at(gone, s + window, -1)
                    out = np.cumsum(gone)[:n] > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8)))
                    removed.append(int(out.sum()))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                    kept.append(words.joined(k, None if not removed[-1] else ~out))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())],
                    ["_id", "n_words", "n_removed", "spans", "kept"],
                )

    return run


def _by_document(found: DataFrame, parts: int, name: str) -> DataFrame:
    """(_id, name): each document's fingerprints from cells packed by document."""
    met = found.repartition(parts, "part").sortWithinPartitions("part")
    return met.mapInArrow(gather, HITS).withColumnRenamed("prints", name)


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, spans, kept): word ranges of repeats and the words left.

    ``kept`` is UTF-8, words joined by one space. ``parts`` is the number of parts of the
    fingerprint space (the session's shuffle partitions): a part's index is held by a task.
    """
    if not 0 < 2 * block <= window + 1:
        raise ValueError("a window must hold a whole block wherever it begins: 2 * block <= window + 1")
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = rows.where(F.col("_id").isNotNull())
    # Copies of a whole text are covered by the least id that has it, wherever they have a window.
    # (An id that several rows share takes the general way.)
    prints = named.select("_id", F.unhex(F.md5("text")).alias("_m"), F.xxhash64("text").alias("_x"))
    leads = prints.groupBy("_m", "_x").agg(F.min("_id").alias("_lead"), F.count("*").alias("_n")).where("_n > 1")
    alone = prints.groupBy("_id").agg(F.count("*").alias("_rows"), F.first("_m").alias("_m"), F.first("_x").alias("_x")).where("_rows = 1")
    # (Written, so that Spark may split a text with many copies in the join.)
    alone, leads = scratch.written(alone.drop("_rows"), "texts"), scratch.written(leads.drop("_n"), "leads")
    copies = alone.join(leads, ["_m", "_x"]).where("_id > _lead").select("_id")
    copies = scratch.written(copies.withColumn("copy", F.lit(True)), "copies")
    anchors = named.mapInArrow(_anchor_cells(parts, window, block), CELLS)
    met = anchors.repartition(parts, "part").sortWithinPartitions("part", "kind")
    hits = _by_document(met.mapInArrow(_probe(parts), CELLS), parts, "hits")
    first_hits = scratch.written(hits, "anchor-hits").join(copies, "_id", "left_anti")
    dealt = named.repartition("_id")
    near = dealt.join(first_hits.hint("shuffle_hash"), "_id").select("_id", "text", "hits")
    compared = near.mapInArrow(_window_cells(parts, window, block), CELLS).repartition(parts, "part").sortWithinPartitions("part")
    covered = _by_document(compared.mapInArrow(_covered(parts), CELLS), parts, "covered")
    marks = covered.join(copies, "_id", "full_outer").withColumn("copy", F.coalesce("copy", F.lit(False)))
    found = dealt.join(marks.hint("shuffle_hash"), "_id", "left").select("_id", "text", "covered", F.coalesce("copy", F.lit(False)).alias("copy"))
    nameless = rows.where(F.col("_id").isNull()).select("_id", "text", F.lit(None).cast("binary").alias("covered"), F.lit(False).alias("copy"))
    schema = "_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    out = found.unionByName(nameless).mapInArrow(_cut(window), schema)
    return out.withColumnRenamed("_id", id_col)
