"""Running positions and sums within keys of any size.

Rows are range-partitioned by (key, order), so a key that holds a third of all rows lies over
many tasks. Each task numbers and sums its own rows; one summary row per task goes to the driver
(so as many rows as there are partitions, whatever the input), which adds up what earlier tasks
hold of a task's first key; a second, narrow pass adds that to the rows of the first key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructType

from clickmodel.llm import scratch

BASE = 0x9E3779B97F4A7C15


def powers(n: np.ndarray) -> np.ndarray:
    """BASE**n modulo 2**64 for every exponent."""
    n = n.astype(np.uint64)
    out, step = np.ones(len(n), np.uint64), BASE
    with np.errstate(over="ignore"):
        while n.any():
            out = np.where(n & np.uint64(1), out * np.uint64(step), out)
            step, n = step * step & (1 << 64) - 1, n >> np.uint64(1)
    return out


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before (NULL equals NULL); the first does not."""
    if len(column) < 2:
        return np.zeros(len(column), bool)
    a, b = column[1:], column[:-1]
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return np.r_[False, differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))]


def _longs(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _within_task(key: str, sums: Sequence[str], polys: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId()
        place, head, seen, last = 0, True, 0, None
        carried = dict.fromkeys([*sums, *polys], np.uint64(0))
        for b in batches:
            if not (n := b.num_rows):
                continue
            new = _changes(b.column(key))
            new[0] = place > 0 and b.column(key)[0].as_py() != last
            index = np.arange(n)
            start = np.maximum.accumulate(np.where(new, index, -1))  # -1: the key goes on from the batch before
            nth = np.where(start < 0, seen + index + 1, index - start + 1)
            runs = {}
            with np.errstate(over="ignore"):
                for c in carried:
                    v = _longs(b.column(c)) * (powers(nth) if c in polys else np.uint64(1))
                    total = np.cumsum(v, dtype=np.uint64)
                    at = np.maximum(start, 0)
                    runs[c] = np.where(start < 0, total + carried[c], total - total[at] + v[at])
            heads = (start < 0) & head
            head, seen, last = bool(heads[-1]), int(nth[-1]), b.column(key)[n - 1].as_py()
            carried = {c: r[-1] for c, r in runs.items()}
            more = [pa.array(np.full(n, chunk), pa.int32()), pa.array(place + index, pa.int64()), pa.array(heads), pa.array(nth, pa.int64())]
            more += [pa.array(r.view(np.int64), pa.int64()) for r in runs.values()]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "chunk", "_place", "_head", "nth", *(f"{c}_run" for c in runs)])
            place += n

    return run


def _add(offset: tuple, nth, runs: list, polys: list[bool]):
    """The positions and runs of rows that follow ``offset`` = (rows, runs...) of the same key."""
    with np.errstate(over="ignore"):
        scale = powers(np.array([offset[0]]))[0]
        moved = [np.uint64(o) + (scale * r if p else r) for o, r, p in zip(offset[1:], runs, polys, strict=True)]
    return offset[0] + nth, moved


def _carries(rows: list, names: list[str], polys: list[bool]) -> dict[int, tuple]:
    """For each task, what the tasks before it hold of its first key."""
    out, before = {}, None
    for r in sorted(rows, key=lambda r: r["chunk"]):
        last = r["last"]
        ends = (last["_nth"], *(last[c] & (1 << 64) - 1 for c in names))
        if before is not None and before[0] == r["first"]["k"]:
            out[r["chunk"]] = before[1]
            if last["_head"]:
                n, moved = _add(before[1], ends[0], [np.uint64(x) for x in ends[1:]], polys)
                ends = (n, *map(int, moved))
        before = (last["k"], ends)
    return out


def _shift(carries: dict[int, tuple], names: list[str], polys: list[bool], befores: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunk, head = b.column("chunk").to_numpy(), b.column("_head").to_numpy(zero_copy_only=False)
            nth = b.column("nth").to_numpy().copy()
            runs = [b.column(c).to_numpy().view(np.uint64).copy() for c in names]
            for k in np.unique(chunk[head]).tolist():
                if k in carries:
                    at = head & (chunk == k)
                    nth[at], moved = _add(carries[k], nth[at], [r[at] for r in runs], polys)
                    for r, x in zip(runs, moved, strict=True):
                        r[at] = x
            new = {"nth": pa.array(nth, pa.int64())} | {c: pa.array(r.view(np.int64), pa.int64()) for c, r in zip(names, runs, strict=True)}
            kept = [new.get(c, b.column(c)) for c in b.schema.names if c not in ("_place", "_head")]
            with np.errstate(over="ignore"):
                less = [r - _longs(b.column(c)) * powers(nth) for c, r in zip([n[:-4] for n in names], runs, strict=True) if c in befores]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(x.view(np.int64), pa.int64()) for x in less)],
                [*(c for c in b.schema.names if c not in ("_place", "_head")), *befores.values()],
            )

    return run


def running(df: DataFrame, key: str, order: Sequence[str], sums: Sequence[str] = (), polys: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``nth``, each row's place (from 1) among the rows of its key in ``order``, and
    for each column c of bigint in ``sums`` or ``polys`` the running ``c_run`` up to this row:
    the sum, or the sum of value * BASE**nth, modulo 2**64. ``c_before`` of a poly is its run
    without this row. ``chunk`` numbers the range partition. NULL is a key like others and
    comes first; NULL values count as 0. ``order`` must decide every order that matters."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names, kinds = [f"{c}_run" for c in (*sums, *polys)], [False] * len(sums) + [True] * len(polys)
    dealt = df.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    schema = StructType(df.schema.fields).add("chunk", IntegerType()).add("_place", LongType()).add("_head", BooleanType()).add("nth", LongType())
    for c in names:
        schema = schema.add(c, LongType())
    local = scratch.written(dealt.mapInArrow(_within_task(key, sums, polys), schema), "running")
    ends = local.groupBy("chunk").agg(
        F.min_by(F.struct(F.col(key).alias("k")), "_place").alias("first"),
        F.max_by(F.struct(F.col(key).alias("k"), "_head", F.col("nth").alias("_nth"), *names), "_place").alias("last"),
    )
    carries = _carries(ends.collect(), names, kinds)
    befores = {c: f"{c}_before" for c in polys}
    out = StructType([f for f in schema.fields if f.name not in ("_place", "_head")])
    for c in befores.values():
        out = out.add(c, LongType())
    return local.mapInArrow(_shift(carries, names, kinds, befores), out)
