"""Jobs over files: incremental planning, dynamic overwrite, idempotency, report."""

import datetime as dt
import os

from pyspark.sql import functions as F

from clickmodel.plans.jobs import run_base, run_sessions, run_staging
from clickmodel.plans.planner import plan_dates, plan_files
from clickmodel.sources import testdata as TD
from clickmodel.sources.files import list_partition_dates, list_raw_dates, raw_file_name

from conftest import SF_SMALL

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def _land(spark, root, days=DAYS, drop_platform_on=None):
    raw = TD.raw_events(spark, SF_SMALL, with_items=True)
    for d in days:
        part = raw.where(F.col("event_date") == d.strftime("%Y%m%d"))
        if d == drop_platform_on:
            part = part.drop("platform")
        part.coalesce(1).write.mode("overwrite").parquet(f"{root}/{raw_file_name(d)}")
    os.makedirs(f"{root}/junk", exist_ok=True)
    open(f"{root}/events_2024XX01.parquet", "w").close()   # malformed name is ignored


def _dates(df, col="date"):
    return sorted(r[col] for r in df.collect())


def test_planner_modes(spark):
    raw = spark.createDataFrame([(d,) for d in DAYS], "date date")
    done = spark.createDataFrame([(DAYS[0],)], "date date")
    p = {(r.date, r.status) for r in plan_dates(raw, done).collect()}
    assert p == {(DAYS[0], "skip"), (DAYS[1], "process"), (DAYS[2], "process")}
    p = {(r.date, r.status) for r in plan_dates(raw, done, start=DAYS[2], days=4).collect()}
    assert p == {(DAYS[0], "skip"), (DAYS[1], "process"), (DAYS[2], "process"),
                 (dt.date(2023, 12, 31), "missing")}
    p = {(r.date, r.status) for r in plan_dates(raw, done, start=DAYS[2]).collect()}
    assert p == {(DAYS[0], "skip"), (DAYS[2], "process")}
    p = {(r.date, r.status) for r in plan_dates(raw, done, as_of=DAYS[2]).collect()}
    assert (DAYS[2], "process") not in p
    files = spark.createDataFrame([(raw_file_name(d), d) for d in DAYS], "file_name string, date date")
    landed = spark.createDataFrame([(raw_file_name(DAYS[0]),)], "file_name string")
    assert _dates(plan_files(files, landed, as_of=DAYS[2]), "file_name") == [raw_file_name(DAYS[1])]


def test_listing(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw")
    assert _dates(list_raw_dates(spark, f"{tmp_dir}/raw")) == DAYS
    assert list_raw_dates(spark, f"{tmp_dir}/nothing").count() == 0
    assert list_partition_dates(spark, f"{tmp_dir}/nothing").count() == 0


def test_base_staging_sessions_end_to_end_and_idempotent(spark, tmp_dir):
    raw_dir, base_dir, stg_dir, ses_dir = (f"{tmp_dir}/{n}" for n in ("raw", "base", "stg", "ses"))
    _land(spark, raw_dir, drop_platform_on=DAYS[1])
    rep = run_base(spark, raw_dir, base_dir, start=DAYS[0])
    assert {(r.date, r.status, r.written) for r in rep.collect()} == {(d, "process", True) for d in DAYS}
    base1 = sorted(map(tuple, spark.read.parquet(base_dir).select("event_date_dt", "event_timestamp",
                                                                   "event_name", "platform").collect()))
    assert any(r[3] is None for r in base1)            # day missing a column reads it as NULL
    batched = f"{tmp_dir}/base_batched"
    run_base(spark, raw_dir, batched, batch_days=1)     # one job per day: same rows
    assert sorted(map(tuple, spark.read.parquet(batched).select("event_date_dt", "event_timestamp", "event_name",
                                                              "platform").collect())) == base1
    rep2 = run_base(spark, raw_dir, base_dir)          # second run: everything already processed
    assert {r.status for r in rep2.collect()} == {"skip"}
    base2 = sorted(map(tuple, spark.read.parquet(base_dir).select("event_date_dt", "event_timestamp",
                                                                   "event_name", "platform").collect()))
    assert base1 == base2
    n_base = len(base1)

    assert _dates(run_staging(spark, base_dir, stg_dir, start=DAYS[0], days=2)) == DAYS[:2]
    assert _dates(run_staging(spark, base_dir, stg_dir, start=DAYS[2])) == DAYS[2:]
    stg = spark.read.parquet(stg_dir)
    assert stg.count() == n_base and "_event_date_dt" in stg.columns
    run_staging(spark, base_dir, stg_dir, start=DAYS[0], days=1)   # rewrite one day, others survive
    assert spark.read.parquet(stg_dir).count() == n_base

    TD.traffic_sources(spark, SF_SMALL).write.mode("overwrite").parquet(f"{tmp_dir}/traffic")
    TD.derived_session_properties(spark, SF_SMALL).write.mode("overwrite").parquet(f"{tmp_dir}/derived")
    written = run_sessions(spark, stg_dir, f"{tmp_dir}/traffic", ses_dir, start=DAYS[0], days=3,
                           derived_prefix=f"{tmp_dir}/derived", join_derived=True)
    assert _dates(written) == DAYS
    ses = spark.read.parquet(ses_dir)
    assert ses.count() == ses.select("session_key").distinct().count() > 0
    assert {"session_source", "session_event_count", "is_first_session"} <= set(ses.columns)


def test_bad_dates_are_quarantined_and_not_planned_again(spark, tmp_dir):
    raw_dir = f"{tmp_dir}/raw"
    _land(spark, raw_dir, days=DAYS[:1])
    # a second export for day 2 whose rows carry a malformed event_date
    raw = TD.raw_events(spark, SF_SMALL).where(F.col("event_date") == "20240102")
    raw.withColumn("event_date", F.lit("2024-01-02")).coalesce(1).write.parquet(f"{raw_dir}/{raw_file_name(DAYS[1])}")
    rep = run_base(spark, raw_dir, f"{tmp_dir}/base")
    n = raw.count()
    assert {(r.date, r.written, r.n_quarantined) for r in rep.collect()} == {(DAYS[0], True, 0), (DAYS[1], False, n)}
    assert _dates(list_partition_dates(spark, f"{tmp_dir}/base")) == DAYS[:1]
    assert {r.status for r in run_base(spark, raw_dir, f"{tmp_dir}/base").collect()} == {"skip"}
    assert spark.read.parquet(f"{tmp_dir}/base/_quarantine").count() == n


def test_late_rows_join_their_day_and_are_reported(spark, tmp_dir):
    raw_dir, base = f"{tmp_dir}/raw", f"{tmp_dir}/base"
    _land(spark, raw_dir, days=DAYS[:1])
    run_base(spark, raw_dir, base)
    n1 = spark.read.parquet(base).count()
    raw = TD.raw_events(spark, SF_SMALL)
    late = TD.raw_events(spark, SF_SMALL, duplicates=False).where(F.col("event_date") == "20240101").limit(2).withColumn("event_bundle_sequence_id", F.lit(-1).cast("long")) \
        .withColumn("event_timestamp", F.col("event_timestamp") + 1)
    early = raw.where(F.col("event_date") == "20240103").limit(1)
    raw.where(F.col("event_date") == "20240102").unionByName(late).unionByName(early).coalesce(1) \
        .write.parquet(f"{raw_dir}/{raw_file_name(DAYS[1])}")
    rep = {r.date: r for r in run_base(spark, raw_dir, base).collect()}
    assert rep[DAYS[0]].n_rows == n1 + 2 and rep[DAYS[0]].written
    assert rep[DAYS[2]].status == "other" and rep[DAYS[2]].n_rows == 1
    # the early row did not make its day a processed one: the day's own export still comes
    _land(spark, raw_dir, days=DAYS[2:])
    rep = {r.date: r for r in run_base(spark, raw_dir, base).collect()}
    assert rep[DAYS[2]].status == "process" and rep[DAYS[2]].n_rows > 1
    assert rep[DAYS[2]].n_rows == raw.where(F.col("event_date") == "20240103").select("event_bundle_sequence_id").distinct().count()


def test_sessions_of_a_day_without_rows_are_removed(spark, tmp_dir):
    raw_dir, base, stg, ses = (f"{tmp_dir}/{x}" for x in ("raw", "base", "stg", "ses"))
    _land(spark, raw_dir, days=DAYS[:2])
    run_base(spark, raw_dir, base)
    run_staging(spark, base, stg)
    assert _dates(run_sessions(spark, stg, None, ses, start=DAYS[0], days=2)) == DAYS[:2]
    staged = spark.read.parquet(stg).withColumn("event_name", F.when(F.col("event_date_dt") == DAYS[0], "first_visit").otherwise(F.col("event_name")))
    staged.write.partitionBy("event_date_dt").parquet(f"{tmp_dir}/stg2")
    assert _dates(run_sessions(spark, f"{tmp_dir}/stg2", None, ses, start=DAYS[0], days=2)) == DAYS[1:2]
    assert _dates(list_partition_dates(spark, ses, "session_start_date")) == DAYS[1:2]


def test_listing_is_one_level_and_starts_no_task(spark, tmp_dir):
    import pytest
    _land(spark, f"{tmp_dir}/raw", days=DAYS[:1])
    TD.raw_events(spark, SF_SMALL).limit(1).write.parquet(f"{tmp_dir}/raw/archive/events_20231231.parquet")
    spark.sparkContext.setJobGroup("listing", "")
    listed = list_raw_dates(spark, f"{tmp_dir}/raw")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("listing") == []
    spark.sparkContext.setJobGroup("rest", "")
    assert _dates(listed) == DAYS[:1]
    with pytest.raises(Exception, match="nosuchscheme"):       # only a missing path is an empty listing
        list_raw_dates(spark, "nosuchscheme://x/raw")


def test_a_sum_beyond_bigint_is_folded(spark):
    from clickmodel.registry import wrapped_sum
    rows = [(1, 2**63 - 1)] * 3 + [(2, 5), (2, None), (3, None), (4, -2**63), (4, -2**63), (4, -1), (5, 2**63 - 1), (5, 1), (6, -7)]
    rows += [(7, 1706000000000000 + k) for k in range(6000)]  # a day's timestamps
    got = spark.createDataFrame(rows, "k int, v bigint").groupBy("k").agg(wrapped_sum("v").alias("s"))
    exact = {k: sum(v for j, v in rows if j == k and v is not None) for k in range(1, 8)}
    want = {k: None if k == 3 else (s + 2**63) % 2**64 - 2**63 for k, s in exact.items()}
    assert exact[7] > 2**63 and want[2] == 5 and want[6] == -7
    assert dict(map(tuple, got.collect())) == want and dict(got.dtypes)["s"] == "bigint"


def test_files_per_day_follow_size_not_shuffle_partitions(spark, tmp_dir):
    import glob
    from clickmodel.sources.sinks import write_partitioned
    df = spark.range(3000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS d", "id").repartition(40)
    days = write_partitioned(df, f"{tmp_dir}/out", "d")
    assert len(days) == 30
    assert len(glob.glob(f"{tmp_dir}/out/d=*/part-*.parquet")) <= 60


def test_read_days_keeps_undeclared_members_and_accepts_flag_types(spark, tmp_dir):
    from clickmodel.sources.files import read_days
    raw = TD.raw_events(spark, SF_SMALL).limit(3)
    for day, kind in zip(DAYS, ("bigint", "int", "string"), strict=True):
        flags = F.col("privacy_info").withField("analytics_storage", F.col("privacy_info.analytics_storage").cast(kind))
        items = F.array(F.struct(F.lit("a").alias("item_id"), F.lit("brand").alias("item_brand")))
        raw.withColumn("privacy_info", flags).withColumn("items", items).withColumn("extra", F.lit(1)) \
            .write.parquet(f"{tmp_dir}/raw/{raw_file_name(day)}")
    one = read_days(spark, f"{tmp_dir}/raw", DAYS[:1])
    assert dict(one.dtypes)["privacy_info"].startswith("struct<analytics_storage:bigint")
    got = read_days(spark, f"{tmp_dir}/raw", DAYS)
    assert dict(got.dtypes)["privacy_info"].startswith("struct<analytics_storage:string") and "extra" in got.columns
    assert got.where("items[0].item_brand = 'brand' and items[0].price is null").count() == 9


def test_load_refuses_repeated_keys(spark, tmp_dir):
    import pytest
    from clickmodel.sources.sinks import load_warehouse
    with pytest.raises(ValueError, match="event_key"):
        load_warehouse(spark.createDataFrame([("a",), ("a",)], "event_key string"), path=f"{tmp_dir}/x")


def test_session_with_only_boundary_events_has_no_row(spark):
    from clickmodel.operators.sessions import build_sessions
    from clickmodel.operators.staging import stage_events
    from clickmodel.operators.base import base_events
    from clickmodel.operators.dedup import dedup_events
    staged = stage_events(dedup_events(base_events(TD.raw_events(spark, SF_SMALL, with_items=False))))
    names = staged.groupBy("session_key").agg(F.collect_set("event_name").alias("names"))
    only_boundary = names.where(F.array_size(F.array_except("names", F.array(F.lit("first_visit"),
                                                                              F.lit("session_start")))) == 0)
    sessions = build_sessions(staged)
    assert only_boundary.count() > 0
    assert only_boundary.join(sessions, "session_key", "left_semi").count() == 0
    assert sessions.count() == names.count() - only_boundary.count()


def test_union_days_conforms_drifting_types(spark):
    from clickmodel.sources.files import union_days
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("stream_id", T.LongType()), T.StructField("platform", T.StringType()),
                           T.StructField("geo", T.StructType([T.StructField("city", T.StringType()),
                                                              T.StructField("country", T.StringType())]))])
    a = spark.createDataFrame([(1, "WEB", ("Paris", "France"))],
                              "stream_id bigint, platform string, geo struct<city:string,country:string>")
    b = spark.createDataFrame([("2", ("Rome",)), ("x", None)], "stream_id string, geo struct<city:string>")
    got = sorted(map(tuple, union_days([a, b], schema).select("stream_id", "platform", "geo.city",
                                                             "geo.country").collect()), key=str)
    assert got == sorted([(1, "WEB", "Paris", "France"), (2, None, "Rome", None), (None, None, None, None)], key=str)


def test_load_warehouse_file_branch(spark, tmp_dir):
    import pytest
    from clickmodel.operators import serving_projection
    from clickmodel.operators.base import base_events
    from clickmodel.operators.dedup import dedup_events
    from clickmodel.operators.staging import stage_events
    from clickmodel.sources.sinks import load_warehouse
    served = serving_projection(stage_events(dedup_events(base_events(TD.raw_events(spark, SF_SMALL)))))
    load_warehouse(served, path=f"{tmp_dir}/serving_csv")
    back = spark.read.option("header", "true").csv(f"{tmp_dir}/serving_csv")
    assert back.columns == served.columns and back.count() == served.count()
    load_warehouse(served, path=f"{tmp_dir}/serving_csv")          # full refresh: replaced, not appended
    assert spark.read.option("header", "true").csv(f"{tmp_dir}/serving_csv").count() == served.count()
    with pytest.raises(ValueError):
        load_warehouse(served)


def test_single_file_exports_and_file_plan_rerun(spark, tmp_dir):
    import glob
    import shutil
    from clickmodel.sources.files import read_days
    raw_dir = f"{tmp_dir}/raw"
    _land(spark, raw_dir, days=DAYS[:1])                       # Spark-written directory form
    day = dt.date(2024, 1, 5)                                  # plain single-file export
    TD.raw_events(spark, SF_SMALL).where(F.col("event_date") == "20240105").coalesce(1) \
        .write.parquet(f"{tmp_dir}/one")
    part = glob.glob(f"{tmp_dir}/one/part-*.parquet")[0]
    shutil.copyfile(part, f"{raw_dir}/{raw_file_name(day)}")
    listed = list_raw_dates(spark, raw_dir)
    assert _dates(listed) == [DAYS[0], day]
    n = spark.read.parquet(part).count()
    assert read_days(spark, raw_dir, [day]).count() == n > 0
    files = listed.select("file_name", "date")
    landed = listed.select("file_name")
    assert plan_files(files, landed).count() == 0             # everything landed: rerun plans nothing
