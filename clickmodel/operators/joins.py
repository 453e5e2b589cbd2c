"""Left join of a table that holds one row per key, or repeats some keys very often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_KEYS = 1000  # heavy keys at most; all others have under a SKETCH_KEYS-th of the rows or so
SALT_ROWS = 1_000_000  # rows of a heavy key that one salt takes


def heavy_keys(df: DataFrame, key: str, salt_rows: int = SALT_ROWS) -> DataFrame:
    """(key, salts) of the keys with more than ``salt_rows`` rows and into how many parts to cut
    them, from a frequent-items sketch: at most SKETCH_KEYS rows, whatever the table's size."""
    named = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    top = named.agg(F.expr(f"approx_top_k(k, {SKETCH_KEYS}, {10 * SKETCH_KEYS})").alias("top")).select(F.inline("top"))
    return top.where(F.col("count") > salt_rows).select(F.col("item").alias(key), F.ceil(F.col("count") / salt_rows).cast("long").alias("__salts"))


def left_join(left: DataFrame, right: DataFrame, key: str, repeated_keys: bool = False, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``left LEFT JOIN right USING (key)``.

    By contract ``right`` holds one row per key (``operators.quality.unique_violations`` checks
    it); the join is then planned as it is, and Spark may split a hot key of the left side.

    ``repeated_keys=True`` is for a right side that breaks the contract: Spark cannot split a hot
    right key of a left outer join. A sketch finds the right keys with more than ``salt_rows``
    rows. Their right rows are dealt out by salt and the left rows of these keys are copied to
    every salt; a copy that meets no right row is dropped, as others of its row do. All other
    keys join plainly. The left side is planned once; of the right side the key column is read once
    more, for the sketch. Broadcast by hint are only the heavy keys, at most SKETCH_KEYS of them;
    else broadcasts are left to the runtime size check.
    """
    if not repeated_keys:
        return left.join(right, on=key, how="left")
    heavy = F.broadcast(heavy_keys(right, key, salt_rows))
    salts = F.coalesce("__salts", F.lit(1))
    # copies of one row part by the task that reads them
    deal = F.pmod(F.xxhash64(*[c for c, t in right.dtypes if "map<" not in t], F.spark_partition_id()), salts)
    dealt = right.join(heavy, key, "left").withColumn("__salt", deal).drop("__salts").withColumn("__met", F.lit(True))
    copied = left.join(heavy, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    joined = copied.join(dealt, [key, "__salt"], "left").where((F.col("__salts").isNull()) | F.col("__met"))
    return joined.drop("__salt", "__salts", "__met")
