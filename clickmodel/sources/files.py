"""File sources: daily raw exports, partitioned datasets, and their listings.

A listing asks the file system for one level below a prefix: a name per export day or
partition, whatever number of data files lies below. It starts no Spark task and reads no file.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from clickmodel.schema import AS_FOUND, RAW_EVENT
from clickmodel.sources import ledger
from clickmodel.sources.fs import as_day, list_names

RAW_FILE_PATTERN = r"events_(\d{8})\.parquet"
EXPORT_DAY = "__export_day"


def raw_file_name(day: dt.date) -> str:
    return f"events_{day:%Y%m%d}.parquet"


def raw_days(spark: SparkSession, prefix: str) -> list[dt.date]:
    """Days of the ``events_YYYYMMDD.parquet`` exports (files or folders) directly under
    ``prefix``; malformed names and dates are skipped."""
    found = (re.fullmatch(RAW_FILE_PATTERN, n) for n in list_names(spark, prefix))
    return sorted({d for m in found if m and (d := as_day(m[1], "%Y%m%d"))})


def partition_days(spark: SparkSession, prefix: str, column: str = "event_date_dt") -> list[dt.date]:
    """Days of the ``column=YYYY-MM-DD`` partitions directly under ``prefix``; the NULL
    partition and malformed names are skipped."""
    start = f"{column}="
    names = (n[len(start):] for n in list_names(spark, prefix) if n.startswith(start))
    return sorted({d for n in names if (d := as_day(n, "%Y-%m-%d"))})


def days_frame(spark: SparkSession, days: Iterable[dt.date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "date date")


def list_raw_dates(spark: SparkSession, prefix: str) -> DataFrame:
    """(date, file_name) of the raw exports under ``prefix``."""
    days = raw_days(spark, prefix)
    return spark.createDataFrame([(d, raw_file_name(d)) for d in days], "date date, file_name string")


def list_partition_dates(spark: SparkSession, prefix: str, column: str = "event_date_dt") -> DataFrame:
    """(date) of the partitions under ``prefix``."""
    return days_frame(spark, partition_days(spark, prefix, column))


# ------------------------------------------------------------------ types of exports
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: struct members and array elements one by one,
    whole numbers as bigint, other numbers as double, anything else as text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        right = {f.name: f.dataType for f in b.fields}
        left = [T.StructField(f.name, common_type(f.dataType, right.pop(f.name, T.NullType()))) for f in a.fields]
        return T.StructType([*left, *[T.StructField(n, t) for n, t in right.items()]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, _NUMBER) and isinstance(b, _NUMBER):
        return T.DoubleType()
    return T.StringType()


def model_type(found: T.DataType, declared: T.DataType) -> T.DataType:
    """``found`` with the declared type of every member that the model names; all others are
    kept as they are. A member declared ``AS_FOUND`` keeps its own type."""
    if isinstance(declared, type(AS_FOUND)):
        return T.StringType() if isinstance(found, T.NullType) else found
    if isinstance(found, T.StructType) and isinstance(declared, T.StructType):
        want = {f.name: f.dataType for f in declared.fields}
        have = [T.StructField(f.name, model_type(f.dataType, want.pop(f.name, AS_FOUND))) for f in found.fields]
        return T.StructType([*have, *[T.StructField(n, model_type(T.NullType(), t)) for n, t in want.items()]])
    if isinstance(found, T.ArrayType) and isinstance(declared, T.ArrayType):
        return T.ArrayType(model_type(found.elementType, declared.elementType))
    if isinstance(declared, T.StructType):
        return model_type(T.StructType([]), declared)
    if isinstance(declared, T.ArrayType):
        return T.ArrayType(model_type(T.NullType(), declared.elementType))
    return declared


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def shaped(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` of type ``have`` as ``want``, member by member; a value that does not fit is NULL."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        members = [(shaped(c.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*members))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: shaped(x, have.elementType, want.elementType))
    if isinstance(want, _NESTED):
        return F.lit(None).cast(want)
    return (F.to_json(c) if isinstance(have, _NESTED) else c).try_cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; absent columns become NULLs."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (shaped(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def union_days(frames: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by column name over the frames' common types; columns that a frame lacks are NULL.
    With a ``schema`` its members have the declared types."""
    found = reduce(common_type, (f.schema for f in frames))
    target = model_type(found, schema) if schema is not None else found
    return reduce(lambda a, b: a.unionByName(b), [conform(f, target) for f in frames])


def _export_day() -> Column:
    """The export day in the path that a row was read from."""
    return F.try_to_date(F.regexp_extract(F.input_file_name(), rf".*/{RAW_FILE_PATTERN}(/|$)", 1), "yyyyMMdd")


def _scan(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    return spark.read.options(mergeSchema="true", **options).parquet(*paths)


def same_types(a: T.DataType, b: T.DataType) -> bool:
    """Whether no member that both have differs in type, so that one scan can read both."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        right = {f.name: f.dataType for f in b.fields}
        return all(same_types(f.dataType, right.get(f.name, f.dataType)) for f in a.fields)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same_types(a.elementType, b.elementType)
    return a == b


def scan_groups(schemas: Iterable[tuple[str, T.StructType]]) -> list[tuple[T.StructType, list[str]]]:
    """Paths that one scan can read, each group with its merged schema."""
    distinct: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in schemas:
        distinct.setdefault(schema.json(), (schema, []))[1].append(path)
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, paths in distinct.values():
        at = next((k for k, (g, _) in enumerate(groups) if same_types(g, schema)), None)
        if at is None:
            groups.append((schema, paths))
        else:
            groups[at] = (common_type(groups[at][0], schema), groups[at][1] + paths)
    return groups


FOOTERS = "path string, file string, schema string"


def _footer_reader():
    """Turns paths into (path, file, schema as JSON) of the Parquet files at or below each. A path in
    a store that a task cannot open by itself has one row without a file. (A function made
    here, so that tasks need not import this package.)"""

    def rows_of(path: str) -> list[tuple]:
        fs, root = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path) if ":" in path else f"file://{path}")
        info = fs.get_file_info(root)
        found = [info] if info.is_file else [x for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.is_file]
        out = []
        for x in found:
            below = x.path[len(root.rstrip("/")):]
            if x.size and not re.search(r"(^|/)[_.][^/]*$", below):
                schema = pq.read_schema(x.path, filesystem=fs)
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                out.append((path, path.rstrip("/") + below, own.decode() if own else from_arrow_schema(schema).json()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                try:
                    rows = rows_of(path)
                except (pa.ArrowException, OSError, NotImplementedError):
                    rows = [(path, None, None)]
                columns = zip(*rows, strict=True) if rows else [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "file", "schema"])

    return run


def footer_schemas(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, T.StructType]]:
    """(file, schema) of every file at or below ``paths``, from one job that reads their footers in
    tasks, whatever the number of paths. Paths in a store that only Spark's readers reach are
    read one schema at a time."""
    tasks = max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4))
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks).mapInArrow(_footer_reader(), FOOTERS).collect()
    parsed: dict[str, T.StructType] = {}
    out = []
    for r in sorted(rows, key=lambda r: (r["path"], r["file"] or "")):
        if r["file"] is None:
            out.append((r["path"], _scan(spark, [r["path"]]).schema))
            continue
        if r["schema"] not in parsed:
            parsed[r["schema"]] = ledger.nullable(T.StructType.fromJson(json.loads(r["schema"])))
        out.append((r["file"], parsed[r["schema"]]))
    return out


def scans(spark: SparkSession, paths: Sequence[str], **options) -> list[DataFrame]:
    """The files at ``paths`` in as few scans as their types allow: one, with the schema merged from
    all footers, unless types conflict (INT32 in one file, INT64 or text in another)."""
    try:
        return [_scan(spark, paths, **options)]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    return [spark.read.options(**options).schema(s).parquet(*p) for s, p in scan_groups(footer_schemas(spark, paths))]


def read_days(spark: SparkSession, prefix: str, days: Iterable[dt.date], schema: T.StructType = RAW_EVENT,
              export_day: bool = False) -> DataFrame:
    """The daily exports of ``days`` with all their columns, parameter value types and item
    fields; the members that ``schema`` names get its types (a value that does not fit is NULL).

    One scan whose schema is merged from the files' footers in one distributed read. Only where
    types conflict (INT32 in one file, INT64 or text in another) the files are grouped by their
    own schemas, read by one more job: one scan per group without a conflict, then a union over
    the common types. ``export_day`` adds the day of the file each row came from.
    """
    paths = [f"{prefix.rstrip('/')}/{raw_file_name(d)}" for d in days]
    if not paths:
        return spark.createDataFrame([], model_type(T.StructType([]), schema))
    frames = scans(spark, paths)
    if export_day:
        frames = [f.withColumn(EXPORT_DAY, _export_day()) for f in frames]
        schema = T.StructType([*schema.fields, T.StructField(EXPORT_DAY, T.DateType())])
    return union_days(frames, schema)


def read_partitioned(spark: SparkSession, prefix: str, days: Iterable[dt.date] | None = None,
                     column: str = "event_date_dt") -> DataFrame:
    """A dataset partitioned by day, or only its partitions of ``days``.

    Only the partition folders asked for are listed. Their schemas come from the ledger stored
    beside the data (``sources.ledger``), so no footer is opened before the scan; the footers of
    days that the ledger does not know are read, and of no others. Days whose types conflict are
    read in scans of their own and united over the common types. A dataset that is not partitioned
    by ``column`` is read as a whole.
    """
    prefix = prefix.rstrip("/")
    folders = {n: as_day(n[len(column) + 1:], "%Y-%m-%d") for n in list_names(spark, prefix) if n.startswith(f"{column}=")}
    if not folders:
        return spark.read.option("mergeSchema", "true").parquet(prefix)
    wanted = set(folders.values()) if days is None else set(days)
    chosen = {n: d for n, d in folders.items() if d in wanted}
    if not chosen:  # no such day: no rows, in the shape of the last one
        return read_partitioned(spark, prefix, [max((d for d in folders.values() if d), default=None)], column).limit(0)
    known = ledger.stored_schemas(spark, prefix, chosen.values())
    frames = []
    for schema, paths in scan_groups((f"{prefix}/{n}", known[d]) for n, d in chosen.items() if d in known):
        reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(column, T.DateType())]))
        frames.append(reader.option("basePath", prefix).parquet(*paths))
    if unknown := [f"{prefix}/{n}" for n, d in chosen.items() if d not in known]:
        frames += scans(spark, unknown, basePath=prefix)
    return frames[0] if len(frames) == 1 else union_days(frames)
