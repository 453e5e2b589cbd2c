"""Payload-aware event deduplication and rank-1 selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns that identify one event; the parameter payload is appended so
# that events differing only in their parameters are kept apart.
DEDUP_KEYS = ["event_date_dt", "stream_id", "user_pseudo_id", "session_id", "event_name", "event_timestamp"]


def first_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each group by ``order``.

    Planned as ``row_number() = 1``, which Spark turns into a partial WindowGroupLimit
    before the shuffle and a final one after it: a hot group (even a third of the input)
    ships at most one row per map task, so the shuffle never carries the group whole.
    """
    rn = "__rn"
    order = list(order) or [F.col(k) if isinstance(k, str) else k for k in keys[:1]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def row_order(df: DataFrame) -> list[Column]:
    """A total order of rows in two numbers, whatever their number of columns."""
    columns = [c for c, t in df.dtypes if "map<" not in t]  # maps have no hash
    return [F.xxhash64(*columns), F.hash(*columns)]


def dedup_events(df: DataFrame, keys: Sequence[str | Column] = DEDUP_KEYS, payload: str = "event_params",
                 order: Sequence[str] | None = None, lead: Sequence[str] = ()) -> DataFrame:
    """Drop duplicate events: same key columns and same parameter payload.

    Rows are grouped by a digest of keys and payload before the keys themselves, so the sorts
    compare one number a row, and whole keys and payloads only where digests are equal.
    The survivor is the first by ``order``, by default by two hashes of the whole row, so reruns
    agree; exact copies are interchangeable anyway. The payload is compared as an array: the same
    grouping as by its JSON text, without building a string per row. ``lead`` names keys to sort by
    before the digest, for a reader that wants each task's rows in their order.
    """
    by = [F.col(c) for c in order] if order else [F.struct(*row_order(df))]  # one column: compared in ties alone
    digested = df.withColumn("__digest", F.xxhash64(*keys, payload))
    return first_per_group(digested, [*lead, "__digest", *[k for k in keys if k not in lead], payload], by).drop("__digest")
