"""Sinks: dynamic partition overwrite and the warehouse load."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickmodel.operators.quality import unique_violations
from clickmodel.session import shared_folder
from clickmodel.sources import ledger
from clickmodel.sources.files import read_partitioned
from clickmodel.sources.fs import delete_folder


def observed(seen: Observation, name: str) -> list:
    """A set that was observed; empty where Spark dropped the observation with its empty input."""
    try:
        return seen.get.get(name) or []
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return []


def write_partitioned(df: DataFrame, path: str, partition_col: str, keep_copy: str | None = None,
                      record: bool = True, dealt: bool = False) -> list[dt.date]:
    """Overwrite only the partitions present in ``df`` (others survive); returns their days, as
    observed while the rows were written. ``record`` stores their schema beside the data
    (``sources.ledger``), for readers of a few days.

    ``keep_copy`` also stores the partition value inside the files (the partition column itself
    only lives in directory names). Rows are rebalanced by the partition column first, so the
    runtime merges small days into few tasks and splits large ones: the number of files follows
    the days' sizes, not the number of shuffle partitions. ``dealt`` is for wide rows of few days
    that a shuffle has just dealt out evenly: they are not shuffled again, and every task writes
    a file for each day it holds, so as many files as tasks (whose number follows the rows' size)
    times days.
    """
    if keep_copy:
        df = df.withColumn(keep_copy, F.col(partition_col))
    mark = ledger.open_write(df.sparkSession, path) if record else None
    seen = Observation()
    df = df.observe(seen, F.collect_set(F.col(partition_col).cast("string")).alias("days"))
    ((df if dealt else df.hint("rebalance", partition_col)).sortWithinPartitions(partition_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    days = sorted(dt.date.fromisoformat(d) for d in observed(seen, "days"))
    if mark:
        ledger.close_write(df.sparkSession, path, mark, days, df.drop(partition_col).schema)
    return days


def partition_rows(spark, path: str, partition_col: str, days: list[dt.date]) -> DataFrame:
    """(date, n_rows) of written partitions, counted from their files' footers."""
    if not days:
        return spark.createDataFrame([], "date date, n_rows bigint")
    read = read_partitioned(spark, path, days, partition_col)
    return read.groupBy(F.col(partition_col).cast("date").alias("date")).agg(F.count("*").alias("n_rows"))


# The serving columns that hold JSON text.
JSON_COLUMNS = ("ecommerce", "items", "event_params")


def load_warehouse(df: DataFrame, url: str | None = None, table: str = "staged_events",
                   properties: dict | None = None, path: str | None = None, fmt: str = "csv",
                   max_connections: int = 8, batch_size: int = 10000, key: str | None = "event_key",
                   staging: str | None = None) -> None:
    """Full-refresh load of the serving projection.

    The rows are evaluated once, into a staging folder (by default a new one in the session's
    shared folder); the key check reads the key column there, the load reads the rows there,
    and the folder is deleted at the end. ``key`` is the table's primary key: a repeated or
    missing value fails before the target is touched (None skips the check). With a JDBC
    ``url``: overwrite with ``truncate=true`` (table definition kept, rows replaced), written by
    at most ``max_connections`` tasks in batched inserts; a table that must be created gets JSON
    columns. Without one: write files (CSV with header by default) for a bulk loader.
    """
    if not url and not path:
        raise ValueError("need a JDBC url or an output path")
    spark = df.sparkSession
    folder = f"{(staging or shared_folder(spark)).rstrip('/')}/load-{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
        rows = spark.read.schema(df.schema).parquet(folder)
        if key and (bad := unique_violations(rows, key).limit(1).collect() or rows.where(F.col(key).isNull()).limit(1).collect()):
            raise ValueError(f"{key} is not a key: {bad[0]}")
        if url:
            types = ", ".join(f"{c} JSON" for c in JSON_COLUMNS if c in df.columns)
            w = rows.write.mode("overwrite").option("truncate", "true")
            if types:
                w = w.option("createTableColumnTypes", types)
            w.option("numPartitions", str(max_connections)).option("batchsize", str(batch_size)).jdbc(url, table, properties=properties or {})
        else:
            w = rows.write.mode("overwrite")
            if fmt == "csv":
                w = w.option("header", "true")
            w.format(fmt).save(path)
    finally:
        delete_folder(spark, folder)
