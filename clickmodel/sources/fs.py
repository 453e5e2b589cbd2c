"""The cluster's file system, through the session's JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, prefix: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(prefix)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, prefix: str) -> list[str]:
    """Names one level below ``prefix``; a missing prefix is empty, any other failure is raised."""
    path, fs = file_system(spark, prefix)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, fs = file_system(spark, folder)
    fs.delete(path, True)


def put_text(spark: SparkSession, name: str, text: str = "") -> None:
    """Writes a small file."""
    path, fs = file_system(spark, name)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def get_text(spark: SparkSession, name: str) -> str:
    path, fs = file_system(spark, name)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_file(spark: SparkSession, name: str) -> None:
    path, fs = file_system(spark, name)
    fs.delete(path, False)


def as_day(text: str, form: str) -> dt.date | None:
    try:
        return dt.datetime.strptime(text, form).date()
    except ValueError:
        return None
