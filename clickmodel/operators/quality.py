"""Data-quality checks expressed as DataFrames (empty result = check passes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, key: str = "event_key") -> DataFrame:
    """Keys that occur more than once, with their count. The count is partially
    aggregated before the shuffle, so a hot key costs one row per map task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def served_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
