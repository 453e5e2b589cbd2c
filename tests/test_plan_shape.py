"""Physical-plan checks: shuffles only where the model needs them, pruning reaches the scan."""

from pyspark.sql import functions as F

from clickmodel.operators import extract_params, normalize_items, stage_events, unnest_key
from clickmodel.operators.base import base_events
from clickmodel.operators.dedup import dedup_events
from clickmodel.operators.sessions import date_window


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _raw_files(spark, tmp_dir):
    from clickmodel.sources import testdata as TD
    from conftest import SF_SMALL
    raw = TD.raw_events(spark, SF_SMALL, with_items=True, duplicates=False)
    raw.write.mode("overwrite").parquet(f"{tmp_dir}/raw")
    return spark.read.parquet(f"{tmp_dir}/raw")


def test_param_and_item_operators_do_not_shuffle(spark, tmp_dir):
    raw = _raw_files(spark, tmp_dir)
    for df in (extract_params(raw), normalize_items(raw), unnest_key(raw, "event_params", "page_title"),
               base_events(raw)):
        p = _plan(df)
        assert "Exchange" not in p, p


def test_staging_adds_no_shuffle_and_dedup_uses_group_limit(spark, tmp_dir):
    raw = _raw_files(spark, tmp_dir)
    base = dedup_events(base_events(raw))
    base_plan = _plan(base)
    assert base_plan.count("Exchange") == 1
    assert "WindowGroupLimit" in base_plan
    staged_plan = _plan(stage_events(base))
    assert staged_plan.count("Exchange") == 1


def test_partition_filter_and_column_pruning(spark, tmp_dir):
    raw = _raw_files(spark, tmp_dir)
    base = base_events(raw).withColumn("d", F.col("event_date_dt"))
    base.write.mode("overwrite").partitionBy("d").parquet(f"{tmp_dir}/base")
    q = date_window(spark.read.parquet(f"{tmp_dir}/base"), "2024-01-02", 2, column="d").select("event_name")
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(d" in p and "2024-01-02" in p
    assert "ReadSchema: struct<event_name:string>" in p


def test_left_join_plan_has_no_broadcast_of_unbounded_side_by_hint(spark):
    from clickmodel.operators.joins import left_join
    a = spark.range(100).withColumn("k", F.col("id").cast("string"))
    b = spark.range(50).withColumn("k", F.col("id").cast("string")).withColumnRenamed("id", "v")
    plan = left_join(a, b, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "BROADCAST" not in plan.upper().replace("BROADCASTHASHJOIN", "")


def test_first_event_per_session_limits_before_shuffle(spark):
    from clickmodel.operators.sessions import first_event_per_session
    # one session holds a third of the rows
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS session_key",
                                       "id AS event_timestamp", "CAST(id AS STRING) AS event_key").repartition(8)
    out = first_event_per_session(df)
    p = _plan(out)
    # partial limit below the exchange, final limit above it
    assert p.count("WindowGroupLimit") == 2
    assert p.index("Exchange hashpartitioning(session_key") < p.rindex("WindowGroupLimit")
    rows = {r.session_key: r.event_timestamp for r in out.collect()}
    assert rows["hot"] == 0 and len(rows) == 20001
