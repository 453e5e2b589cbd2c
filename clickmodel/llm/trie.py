"""Prefix trie of conversations by collapsing whole sequences.

Turns are numbered within their conversation, and each conversation is rebuilt from the first
turns of a base conversation and its own later ones. A prefix is known by its length and a
128-bit polynomial over the turns' digests, kept as a running sum over range partitions, so a
conversation of any length lies over many tasks. Identical rebuilt conversations are grouped
into one weighted sequence with a list of the conversations that it stands for; the turns of
one of them represent it. Sequences that are proper prefixes of others are dropped by an
anti-join, which leaves the leaves. All prefixes of all sequences, weighted, are then aggregated
into nodes. What is summed over subtrees is summed along leaves: every node belongs to one leaf
below it, a running sum from the leaf upwards collects the nodes that belong to it, and a node
adds up the sums of all its leaves at its depth.

Lists of ends are packed in ascending order, one piece for each sequence and range partition; a
digest over a list is sequential by definition, so one task streams through a list's pieces.

Defined results: turns are ordered by turn, NULL first, ties by the digest of role and text;
a NULL role or text is empty; a row without conv_id belongs to no conversation and is left out;
repeated rows are turns of their own; remainders of negative ids are those of SQL (toward zero);
an empty table has no node. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch
from clickmodel.llm.ranges import running

GROUP, MOST = 100, 6  # conversations share the first turns of the one divisible by GROUP, under MOST of them
PIECE = 65536  # ids in a piece of an end list
KEY = ["depth", "p", "q"]
EMPTY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from its base."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv, turn, a, b, chars): the turn's digest in two numbers, and its text's length."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    rows = turns.where(turns["conv_id"].isNotNull())
    return rows.select(turns["conv_id"].cast("long").alias("conv"), turns["turn"].cast("long").alias("turn"), half(1).alias("a"), half(17).alias("b"), F.length(text).cast("long").alias("chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns of the rebuilt ones with the prefixes that end with and before each)."""
    own = running(scratch.written(turn_rows(turns), "turns"), "conv", ["turn", "a", "b", "chars"]).drop("chunk")
    own = scratch.written(own, "own-turns")
    convs = own.select("conv").distinct()
    base = F.col("conv") - F.col("conv") % GROUP
    heads = own.where((F.col("conv") % GROUP == 0) & (F.col("nth") < MOST)).groupBy(F.col("conv").alias("base"))
    heads = heads.agg(F.collect_list(F.struct("nth", "a", "b", "chars")).alias("head"))
    front = convs.withColumn("base", base).join(heads, "base")
    front = front.select("conv", F.explode(F.filter("head", lambda t: t["nth"] <= shared_turns(F.col("conv")))).alias("t"))
    front = front.select("conv", F.lit(0).alias("own"), F.col("t.nth").alias("at"), "t.a", "t.b", "t.chars")
    rest = own.where(F.col("nth") > shared_turns(F.col("conv"))).select("conv", F.lit(1).alias("own"), F.col("nth").alias("at"), "a", "b", "chars")
    rows = running(scratch.written(front.unionByName(rest), "rebuilt"), "conv", ["own", "at"], polys=["a", "b"])
    return convs, rows.select("conv", F.col("nth").alias("depth"), F.col("a_run").alias("p"), F.col("b_run").alias("q"), F.col("a_before").alias("up_p"), F.col("b_before").alias("up_q"), "chars")


PIECES = "depth bigint, p bigint, q bigint, first bigint, n bigint, ids string"


def _same_sequence(b: pa.RecordBatch) -> np.ndarray:
    """Bounds of the runs of rows of one sequence."""
    cols = [b.column(c).to_numpy() for c in KEY]
    new = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)])
    return np.r_[new, b.num_rows]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ascending ids of each sequence, comma-joined; rows come sorted by (sequence, conv)."""
    key, held = None, []

    def close():
        row = dict(zip(KEY, key, strict=True)) | {"first": held[0], "n": len(held), "ids": ",".join(map(str, held))}
        return pa.RecordBatch.from_pylist([row], pa.schema([(c, pa.int64()) for c in (*KEY, "first", "n")] + [("ids", pa.string())]))

    for b in batches:
        if not b.num_rows:
            continue
        bounds, ids = _same_sequence(b).tolist(), b.column("conv").to_pylist()
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            now = tuple(b.column(c)[s].as_py() for c in KEY)
            for at in range(s, e, PIECE):
                if key is not None and (now != key or len(held) >= PIECE):
                    yield close()
                    held = []
                key = now
                held += ids[at : min(e, at + PIECE)]
    if held:
        yield close()


SEQUENCES = "depth bigint, p bigint, q bigint, conv bigint, weight bigint, ends_sha256 string"


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least id, number and digest of the ids of each sequence; rows come sorted by (sequence, first id)."""
    key, first, n, sha = None, None, 0, None
    schema = pa.schema([(c, pa.int64()) for c in (*KEY, "conv", "weight")] + [("ends_sha256", pa.string())])
    for b in batches:
        out = []
        for r in b.to_pylist():
            now = tuple(r[c] for c in KEY)
            if now != key:
                if key is not None:
                    out.append((*key, first, n, sha.hexdigest()))
                key, first, n, sha = now, r["first"], 0, hashlib.sha256()
            sha.update((b"," if n else b"") + r["ids"].encode())
            n += r["n"]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, first, n, sha.hexdigest()), strict=True))], schema)


def collapsed(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per distinct sequence: its last prefix, least conversation, weight and digest of its end list."""
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = convs.select("conv", *[F.lit(0).cast("long").alias(c) for c in KEY])
    last = rows.select("conv", *KEY).unionByName(start).groupBy("conv").agg(F.max_by(F.struct(*KEY), "depth").alias("s")).select("conv", "s.*")
    pieces = scratch.written(last, "last").repartitionByRange(parts, *KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(_pieces, PIECES)
    return scratch.written(pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_sequences, SEQUENCES), "sequences")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    convs, rows = rebuilt(turns)
    rows = scratch.written(rows, "prefixes")
    sequences = collapsed(convs, rows)
    root = [F.lit(0).cast("long").alias(c) for c in (*KEY, "up_p", "up_q", "chars")]
    paths = rows.join(sequences.select("conv", "weight", F.col("depth").alias("length")), "conv")
    paths = paths.unionByName(sequences.select("conv", *root, "weight", F.col("depth").alias("length")))
    paths = scratch.written(paths, "paths")
    proper = paths.where("depth < length").select(*KEY).distinct()
    leaves = scratch.written(sequences.join(proper, KEY, "left_anti").select("conv", F.lit(1).cast("long").alias("leaf")), "leaves")
    nodes = paths.join(leaves, "conv", "left").groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"),
        F.max("up_p").alias("up_p"), F.max("up_q").alias("up_q"), F.max("chars").alias("chars"),
        F.min(F.when(F.col("leaf") == 1, F.col("conv"))).alias("leaf"),
    )
    nodes = scratch.written(nodes, "nodes")
    # Each node's own saving stands in the path of its leaf; sums from the leaf up to each depth.
    own = nodes.select(F.col("leaf").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    upward = paths.join(leaves.select("conv"), "conv", "left_semi").select("conv", *KEY).join(own, ["conv", "depth"], "left")
    upward = scratch.written(upward.withColumn("below", -F.col("depth")), "upward")
    saved = running(upward, "conv", ["below"], sums=["saved"]).groupBy(*KEY).agg(F.sum("saved_run").alias("saved_tokens"))
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_p").alias("p"), F.col("up_q").alias("q")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    ends = sequences.select(*KEY, "ends_sha256")
    whole = nodes.join(saved, KEY).join(children, KEY, "left").join(ends, KEY, "left")
    whole = scratch.written(whole, "trie")
    above = whole.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("up_p"), F.col("q").alias("up_q"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(above, ["depth", "up_p", "up_q"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
