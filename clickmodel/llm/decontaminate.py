"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts (questions and answers) are normalised to words; every window of ten
consecutive words (a shorter item: all its words) is a pattern of one automaton. Each document
is normalised once to its words joined by single spaces and scanned once; matches come back as
word ranges, and the words' byte ranges give the character offsets in the original text.

The automaton is the only thing sent to all workers. Its patterns are counted first; over
``max_pattern_bytes`` the patterns are dealt into several automata of that size, and the
documents are scanned once for each, in stages of their own, so that a worker holds one.

Defined results: NULL and empty texts have no words and are clean; items without a word have no
pattern; items with a NULL id mark words but are not listed; repeated rows are judged apart;
an empty benchmark leaves every document clean; an empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch

WINDOW = 10
MAX_PATTERN_BYTES = 8 << 20  # an automaton takes some 40 times as much memory, in every worker
# Upper-case ASCII letters to lower case, all other ASCII but digits and letters to a space.
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_AUTOMATA: dict[str, object] = {}



def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def windows_of(text: str | None, size: int = WINDOW) -> set[bytes]:
    """The distinct windows of an item, words joined by one space."""
    w = normal_words(text)
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def benchmark_patterns(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(pattern, n_words, item_ids): each distinct window with the items that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                if p := sorted(windows_of(t, size)):
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(p), pa.int64()), pa.array(p, pa.binary())], ["item", "pattern"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "item bigint, pattern binary").groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))


def _automaton(key: str, broadcast):
    """The automaton of a broadcast pattern list, built once per worker."""
    import ahocorasick

    if key not in _AUTOMATA:
        a = ahocorasick.Automaton()
        for pattern, items in broadcast.value:
            a.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(items)))
        if len(a):
            a.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = a
    return _AUTOMATA[key]


def scan(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], set]:
    """(number of words, merged hit word ranges [start, end), items) of one text."""
    words = normal_words(text)
    if not words:
        return 0, [], set()
    normal = " " + b" ".join(words).decode("latin-1") + " "
    ends, sizes, items = [], [], set()
    for end, (size, ids) in automaton.iter(normal) if len(automaton) else ():
        ends.append(end)
        sizes.append(size)
        items.update(ids)
    if not ends:
        return len(words), [], items
    # The match ends on the space after its last word: how many words end before it?
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    after = np.cumsum(lengths + 1)  # position of the space behind word k
    last = np.searchsorted(after, np.array(ends, np.int64)) + 1
    spans = merged(zip((last - np.array(sizes)).tolist(), last.tolist(), strict=True))
    return len(words), spans, items


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as character ranges of the original text."""
    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(data.translate(NORMAL))]
    chars = lambda n: len(data[:n].decode("utf-8", "surrogatepass"))
    return [{"start": chars(at[s][0]), "end": chars(at[e - 1][1])} for s, e in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PAIRS_SQL = "array<struct<start:bigint,end:bigint>>"


def _scanner(key: str, broadcast, n_keep: int):
    """One pass: adds an automaton's items and word ranges to those of earlier passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, broadcast)
        for b in batches:
            ns, items, ranges = [], [], []
            for t, i, r in zip(b.column("_text"), b.column("_items").to_pylist(), b.column("_ranges").to_pylist(), strict=True):
                n, spans, ids = scan(t.as_py(), automaton)
                ns.append(n)
                items.append(sorted(ids.union(i) - {None}))
                ranges.append([{"start": x, "end": y} for x, y in merged([*spans, *((x["start"], x["end"]) for x in r)])])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(n_keep + 1)], pa.array(ns, pa.int64()), pa.array(items, pa.list_(pa.int64())), pa.array(ranges, _PAIRS)],
                [*b.schema.names[: n_keep + 1], "_n", "_items", "_ranges"],
            )

    return run


def _finish(n_keep: int):
    """Counts hit words and maps the word ranges to offsets of the original text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranges = [[(x["start"], x["end"]) for x in r] for r in b.column("_ranges").to_pylist()]
            hits = [sum(e - s for s, e in r) for r in ranges]
            spans = [original_offsets(t.as_py(), r) if r else [] for t, r in zip(b.column("_text"), ranges, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(n_keep)], b.column("_n"), pa.array(hits, pa.int64()), b.column("_items"), pa.array(spans, _PAIRS)],
                [*b.schema.names[:n_keep], "n_words", "n_hit", "item_ids", "spans"],
            )

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_pattern_bytes: int = MAX_PATTERN_BYTES, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` plus n_words, n_hit, item_ids (occurring items) and spans (original offsets)."""
    spark = docs.sparkSession
    patterns = scratch.written(benchmark_patterns(benchmark, size), "patterns")
    total = patterns.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    shards = max(1, math.ceil(1.1 * total / max_pattern_bytes)) if total > max_pattern_bytes else 1
    rows = docs.select(*keep, F.col(text_col).alias("_text"), F.lit(0).cast("long").alias("_n"),
                       F.array().cast("array<bigint>").alias("_items"), F.array().cast(_PAIRS_SQL).alias("_ranges"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)]]
    state = ", ".join([*kept, "_text string", f"_n bigint, _items array<bigint>, _ranges {_PAIRS_SQL}"])
    for k in range(shards):
        part = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == k)
        shared = spark.sparkContext.broadcast([(bytes(p), list(i)) for p, i in part.collect()])
        rows = rows.mapInArrow(_scanner(uuid.uuid4().hex, shared, len(keep)), state)
        if k < shards - 1:
            rows = scratch.written(rows, "scanned")
    return rows.mapInArrow(_finish(len(keep)), ", ".join([*kept, f"n_words bigint, n_hit bigint, item_ids array<bigint>, spans {_PAIRS_SQL}"]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without a benchmark window, with exactly the input's columns (stage form)."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["text"].alias("text"))
    clean = find_contamination(packed, benchmark, keep=("_row",), **how).where("n_hit = 0")
    return clean.select(*[F.col("_row").getField(c).alias(c) for c in names])
