"""Incremental date / file planning as DataFrame set algebra.

Dates are rows, not driver-side sets: candidate days come from ``sequence``/``explode`` or
from the raw listing, already-processed days are removed with a left-anti join and the skip
report is a left-semi join, so the plan is the same for 10 or 10 million partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROCESS, SKIP, MISSING = "process", "skip", "missing"


def _date_value(v) -> Column:
    """A date given as text, ``date``, Column, or one-row/one-column DataFrame."""
    if isinstance(v, DataFrame):
        return v.scalar().cast("date")
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, dt.date):
        return F.lit(v)
    return F.lit(str(v)).cast("date")


def plan_dates(raw: DataFrame, processed: DataFrame, start=None, days: int | None = None, as_of=None,
               column: str = "date") -> DataFrame:
    """(date, status) rows.

    * ``(start, days)``: the ``days`` dates counting back from ``start`` (inclusive);
    * ``start`` only: raw dates on or after ``start``;
    * neither: every raw date.

    Candidates already processed are dropped. Remaining candidates are ``process`` when a raw
    export exists and ``missing`` otherwise; processed dates that are also raw are ``skip``.
    ``as_of`` hides raw exports of that day and later (still being written).
    """
    if days is not None and start is None:
        raise ValueError("days needs a start date")
    raw = raw.select(F.col(column).cast("date").alias("date")).where(F.col("date").isNotNull())
    if as_of is not None:
        raw = raw.where(F.col("date") < _date_value(as_of))
    raw = raw.distinct()
    done = processed.select(F.col(column).cast("date").alias("date")).where(F.col("date").isNotNull()).distinct()

    if start is not None and days is not None:
        if days < 1:
            raise ValueError("days must be >= 1")
        s = _date_value(start)
        cand = raw.sparkSession.range(1).select(
            F.explode(F.sequence(F.date_sub(s, days - 1), s)).alias("date"))
    elif start is not None:
        cand = raw.where(F.col("date") >= _date_value(start))
    else:
        cand = raw

    todo = cand.join(done, "date", "left_anti")
    raw_flag = raw.select("date", F.lit(True).alias("__raw"))
    todo = todo.join(raw_flag, "date", "left").select(
        "date", F.when(F.col("__raw"), F.lit(PROCESS)).otherwise(F.lit(MISSING)).alias("status"))
    skipped = done.join(raw, "date", "left_semi").select("date", F.lit(SKIP).alias("status"))
    return todo.unionByName(skipped)


def plan_files(raw_files: DataFrame, landed: DataFrame, as_of=None, name: str = "file_name",
               date: str = "date") -> DataFrame:
    """Raw export files to land: not yet landed, and older than ``as_of`` (today's file is
    still changing). Idempotent: a rerun after landing returns nothing."""
    f = raw_files
    if as_of is not None:
        f = f.where(F.col(date) < _date_value(as_of))
    return f.join(landed.select(name), name, "left_anti").select(name)
