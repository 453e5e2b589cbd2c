"""Schemas stored beside a partitioned dataset, so that a reader of a few days opens no other footers.

``<prefix>/_schemas/`` holds each distinct schema once (``<digest>.json``) and an empty file
``<day>.<digest>`` for every day, so one listing tells the schema of every day. A write holds a
file ``writing-<id>`` there while it lasts; days are trusted only where no write is open, and a
day with two schemas is not trusted. What the ledger does not tell is read from the footers of
the days that are asked for.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from clickmodel.sources.fs import as_day, delete_file, get_text, list_names, put_text

FOLDER = "_schemas"
WRITING = "writing-"


def nullable(kind: T.DataType) -> T.DataType:
    """The type as files are read: every member may be NULL, and no metadata."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    return kind


def open_write(spark: SparkSession, prefix: str) -> str:
    """Marks a write of the dataset as open; the mark is for ``close_write``."""
    mark = f"{prefix}/{FOLDER}/{WRITING}{uuid.uuid4().hex}"
    put_text(spark, mark)
    return mark


def close_write(spark: SparkSession, prefix: str, mark: str, days: Iterable[dt.date], schema: T.StructType) -> None:
    """Records the schema of the days that the write replaced, and removes its mark."""
    folder, text = f"{prefix}/{FOLDER}", json.dumps(nullable(schema).jsonValue(), sort_keys=True)
    digest = hashlib.md5(text.encode()).hexdigest()
    names = list_names(spark, folder)
    if f"{digest}.json" not in names:
        put_text(spark, f"{folder}/{digest}.json", text)
    new = {f"{d}.{digest}" for d in days}
    days_written = {n.partition(".")[0] for n in new}
    for n in new - set(names):
        put_text(spark, f"{folder}/{n}")
    for n in set(names) - new:
        if n.partition(".")[0] in days_written:
            delete_file(spark, f"{folder}/{n}")
    delete_file(spark, mark)


def forget(spark: SparkSession, prefix: str, days: Iterable[dt.date]) -> None:
    """Removes the entries of days whose partitions were deleted."""
    gone = {str(d) for d in days}
    for n in list_names(spark, f"{prefix}/{FOLDER}"):
        if n.partition(".")[0] in gone:
            delete_file(spark, f"{prefix}/{FOLDER}/{n}")


def settle(spark: SparkSession, prefix: str) -> None:
    """For the owner of a dataset, when no write is running: drops the marks that broken writes
    left, and with them every entry, as any day may have been rewritten. Days are then read
    from their footers until they are written again."""
    if any(n.startswith(WRITING) for n in list_names(spark, f"{prefix}/{FOLDER}")):
        for n in list_names(spark, f"{prefix}/{FOLDER}"):
            if not n.endswith(".json"):
                delete_file(spark, f"{prefix}/{FOLDER}/{n}")


def stored_schemas(spark: SparkSession, prefix: str, days: Iterable[dt.date]) -> dict[dt.date, T.StructType]:
    """The schemas of those of ``days`` that the ledger knows for sure."""
    names = list_names(spark, f"{prefix}/{FOLDER}")
    if any(n.startswith(WRITING) for n in names):
        return {}
    wanted, found = set(days), {}
    for n in names:
        day, _, digest = n.partition(".")
        if (d := as_day(day, "%Y-%m-%d")) in wanted and d is not None:
            found.setdefault(d, []).append(digest)
    schemas: dict[str, T.StructType] = {}
    out = {}
    for d, digests in found.items():
        if len(digests) == 1 and f"{digests[0]}.json" in names:
            if digests[0] not in schemas:
                schemas[digests[0]] = T.StructType.fromJson(json.loads(get_text(spark, f"{prefix}/{FOLDER}/{digests[0]}.json")))
            out[d] = schemas[digests[0]]
    return out
