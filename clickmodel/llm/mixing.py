"""Mixing sources to target weights by entropy balancing.

The words a source should give are a constraint on the sum of ``size * rate`` over its
documents. Among all rates up to ``cap`` copies, the one nearest to rate 1 in relative entropy is
exponentially tilted: ``rate = min(cap, exp(lambda * size))``, with one multiplier per source.
The multipliers solve a convex dual. Each Newton step is one distributed aggregation over the
(source, size) counts of all documents, kept inside a bracket that always holds the root; the
multipliers stay a DataFrame with a row per source.

Rates become copies by error diffusion: chunks of a source (a hot source has many) run through
their documents from long to short, and each document takes the number of copies, 0 to ``cap``,
that brings the chunk's words nearest to the sum of its rates so far; what is left over is about
half of a short document. Sums are decimal, and
order is by size and id, so reruns agree.

Defined results: NULL and empty texts have size 0, and copies are 1 of no words; a NULL source is
a source of its own, last in order; a source without words has target 0; repeated rows are
documents of their own; an empty table gives an empty result. Extra columns are not read, or are
carried unchanged inside ``keep``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmodel.llm import rules, scratch

CAP = 3
WEIGHTS = (1, 2, 3)  # of the sources in code point order, repeating
NEWTON_STEPS = 40  # at most; all sources are done much earlier
TOLERANCE = 1e-9
CHUNK_ROWS = 1000


def word_count(text: Column) -> Column:
    return F.size(rules.words_of(F.coalesce(text, F.lit("")))).cast("long")


def source_targets(counts: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, n_docs, source_size, target) from (source, size, n) counts.

    Targets share all words by weight, stop at ``cap`` times their source's size, and reshare the
    excess: they are ``min(cap * source_size, level * weight)`` with the level at which they add
    up. One row per source goes through the ordered windows in one task, never one per document: meant
    for up to some millions of sources.
    """
    src = counts.groupBy("source").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    src = src.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights)))
    by_fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    src = src.withColumn("limit", (F.col("source_size") * cap).cast("double"))
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    src = src.withColumn("level", left / F.sum("weight").over(rest))
    open_level = F.min(F.when(F.col("limit") / F.col("weight") >= F.col("level"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)
    return src.select(
        "source", "n_docs", "source_size", "least",
        F.least("limit", F.coalesce(open_level["level"] * F.col("weight"), F.col("limit"))).alias("target"),
    )


def solve_multipliers(counts: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``targets`` plus ``multiplier``: the root of the dual of each source."""
    t, s, least = F.col("target"), F.col("source_size"), F.col("least")
    top = F.lit(math.log(cap)) / least
    state = targets.select(
        "*",
        F.when(t >= s, F.lit(0.0)).otherwise(F.log(t / s) / least).alias("lo"),
        F.when(t >= s, top).otherwise(F.lit(0.0)).alias("hi"),
        F.when(t >= s * cap, top).otherwise(F.lit(0.0)).alias("multiplier"),
        ((t <= 0) | (t >= s * cap) | least.isNull()).alias("done"),
    )
    state = scratch.written(state, "multipliers")
    for _ in range(NEWTON_STEPS):
        if state.where(~F.col("done")).isEmpty():
            break
        open_ = state.where(~F.col("done")).select(F.col("source").alias("_s"), F.col("multiplier").alias("_m"))
        rate = F.least(F.lit(float(cap)), F.exp(F.col("_m") * F.col("size")))
        words = F.col("n") * F.col("size") * rate
        bend = F.when(rate < cap, words * F.col("size")).otherwise(F.lit(0.0))
        sums = (
            counts.join(open_, F.col("source").eqNullSafe(F.col("_s")))
            .groupBy("_s")
            .agg(F.sum(words.cast("decimal(38,9)")).cast("double").alias("_g"), F.sum(bend.cast("decimal(38,6)")).cast("double").alias("_h"))
        )
        near = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
        m, g = F.col("multiplier"), F.col("_g")
        lo = F.when(g < t, m).otherwise(F.col("lo"))
        hi = F.when(g > t, m).otherwise(F.col("hi"))
        step = m - F.try_divide(F.log(g) - F.log(t), F.col("_h") / g)
        inside = F.coalesce((step > lo) & (step < hi), F.lit(False))
        hit = F.col("done") | (F.abs(g - t) <= t * TOLERANCE) | ((hi - lo) <= F.abs(hi + lo) * 1e-14)
        state = scratch.written(
            near.select(
                *targets.columns,
                F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
                F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
                F.when(hit, m).when(inside, step).otherwise((lo + hi) / 2).alias("multiplier"),
                hit.alias("done"),
            ),
            "multipliers",
        )
    return state.select(*targets.columns, "multiplier")


def _round_copies(cap: int, n_out: int):
    """Rates to copies along each (source, chunk) run; batches may split a run anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry = None, 0.0
        for b in batches:
            sources, chunks = b.column("_source").to_pylist(), b.column("_chunk").to_pylist()
            sizes = b.column("size").to_numpy().astype(float)
            tilt = np.nan_to_num(b.column("_multiplier").to_numpy(zero_copy_only=False).astype(float))
            rates = np.where(b.column("target").to_numpy() > 0, np.minimum(cap, np.exp(np.minimum(tilt * sizes, 50.0))), 0.0)
            rates[sizes == 0] = 1.0
            copies = np.zeros(len(sizes), np.int64)
            for i, (size, rate) in enumerate(zip(sizes.tolist(), rates.tolist(), strict=True)):
                if (now := (sources[i], chunks[i])) != key:
                    key, carry = now, 0.0
                wanted = rate + (carry / size if size else 0.0)
                copies[i] = min(cap, max(0, math.floor(wanted + 0.5)))
                carry += (rate - copies[i]) * size
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n_out)], pa.array(copies)], [*b.schema.names[:n_out], "copies"])

    return run


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``keep`` plus size, source_size, target, copies and taken of every document."""
    held = F.struct(*[F.col(c) for c in keep]).alias("_keep")
    rows = docs.select(held, F.col(source_col).alias("_source"), F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("size"))
    counts = rows.groupBy(F.col("_source").alias("source"), "size").agg(F.count("*").alias("n"))
    counts = scratch.written(counts, "sizes")
    solved = solve_multipliers(counts, scratch.written(source_targets(counts, weights, cap), "targets"), cap)
    rows = rows.join(solved, F.col("_source").eqNullSafe(F.col("source")))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / CHUNK_ROWS))
    out = ["_keep", "size", "source_size", "target"]
    rows = rows.select(*out, "_source", F.pmod(F.xxhash64("_id"), chunks).alias("_chunk"), F.col("multiplier").alias("_multiplier"), "_id")
    rows = rows.repartition("_source", "_chunk").sortWithinPartitions("_source", "_chunk", F.desc("size"), "_id")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(out)]] + ["copies bigint"])
    taken = rows.mapInArrow(_round_copies(cap, len(out)), schema)
    made = ["size", "source_size", "target", "copies"]
    return taken.select(*[F.col("_keep").getField(c).alias(c) for c in keep], *made, (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix takes, with their columns, then size, source_size, target,
    copies and taken (stage form; a clashing column of the input keeps its value as ``<name>_in``)."""
    names = docs.columns
    made = ["size", "source_size", "target", "copies", "taken"]
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["text"].alias("text"), docs["source"].alias("source"), docs["doc_id"].alias("doc_id"))
    out = mix(packed, keep=("_row",), **how).where("copies > 0")
    return out.select(*[F.col("_row").getField(c).alias(f"{c}_in" if c in made else c) for c in names], *made)
