"""Every registered query equals its DuckDB SQL twin (rows, columns, values) at sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from clickmodel import registry as R
from conftest import SF_SMALL

WRITES_FILES = {"read_days", "overwrite_days", "quarantine_days", "list_raw_dates", "list_processed_dates",
                "read_partitioned", "partitions_written"}
TABLES = ["nation", "customer", "orders", "lineitem", "events", "pages"]


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return len(rows), hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(R.queries()) == set(R.oracle_sql()) and set(R.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "session_key" in df.columns


@pytest.mark.parametrize("name", ["select_source", "dedup_events", "plan_dates", "sessions_dim"])
def test_results_independent_of_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        got = _digest(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    rel = con.sql(E.oracle_sql()[name])
    assert got == _digest(rel.columns, rel.fetchall())


SPARK_TO_DUCKDB = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                   "boolean": "BOOLEAN"}


def test_column_types_match_oracle(spark, con):
    bad = []
    for name, fn in R.queries().items():
        if name in WRITES_FILES:
            continue  # compared above; building them runs jobs
        spark_types = dict(fn(spark, SF_SMALL).dtypes)
        rel = con.sql(E.oracle_sql()[name])
        duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        bad += [(name, c, t, duck_types.get(c)) for c, t in spark_types.items()
                if SPARK_TO_DUCKDB.get(t, t) != duck_types.get(c)]
    assert bad == []
