"""What a job reads and rewrites: footers of its window, one scan of the exports, days with new events."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from clickmodel.operators.joins import left_join
from clickmodel.plans.jobs import run_base, run_sessions, run_staging
from clickmodel.sources import ledger
from clickmodel.sources import testdata as TD
from clickmodel.sources.files import footer_schemas, raw_file_name, read_days, read_partitioned
from clickmodel.sources.sinks import load_warehouse, write_partitioned

from conftest import SF_SMALL

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def _land(spark, root, days=DAYS):
    raw = TD.raw_events(spark, SF_SMALL)
    for d in days:
        raw.where(F.col("event_date") == f"{d:%Y%m%d}").coalesce(1).write.parquet(f"{root}/{raw_file_name(d)}")
    return raw


def _break_footers(root, days, column="event_date_dt"):
    for d in days:
        for f in glob.glob(f"{root}/{column}={d}/*.parquet"):
            with open(f, "wb") as out:
                out.write(b"no footer")


def _files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root}/event_date_dt=*/*.parquet")}


def _scans(spark, start, path):
    """Executed plans since ``start`` that scan files below ``path``."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30000)
    runs = store.executionsList()
    texts = [runs.apply(i).physicalPlanDescription() for i in range(start, runs.size())]
    return runs.size(), [t for t in texts if path in t]


def test_a_day_is_staged_without_other_days_footers(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw")
    base, stg, ses = (f"{tmp_dir}/{x}" for x in ("base", "stg", "ses"))
    run_base(spark, f"{tmp_dir}/raw", base)
    whole = read_partitioned(spark, base)
    n, columns = whole.where(F.col("event_date_dt") == DAYS[1]).count(), sorted(whole.columns)
    _break_footers(base, [DAYS[0], DAYS[2]])
    rep = run_staging(spark, base, stg, start=DAYS[1], days=1).collect()
    assert [(r.date, r.n_rows) for r in rep] == [(DAYS[1], n)]
    assert sorted(read_partitioned(spark, base).columns) == columns  # and the whole is planned without any footer
    with pytest.raises(Exception, match="Parquet|footer|parquet"):
        read_partitioned(spark, base).select("event_name").collect()
    assert [(r.date) for r in run_sessions(spark, stg, None, ses, start=DAYS[1]).collect()] == [DAYS[1]]
    assert read_partitioned(spark, base, []).count() == 0


def test_days_the_ledger_does_not_know_are_read_from_their_footers(spark, tmp_dir):
    day = lambda k: F.lit(str(DAYS[k])).cast("date").alias("d")
    out = f"{tmp_dir}/out"
    write_partitioned(spark.range(3).select(day(0), "id", F.struct(F.lit(1).alias("a")).alias("s")), out, "d")
    write_partitioned(spark.range(4).select(day(1), F.col("id").cast("string"), F.struct(F.lit("x").alias("b")).alias("s")), out, "d")
    spark.range(2).select(day(2), F.lit(2.5).alias("more")).write.mode("append").partitionBy("d").parquet(out)  # another writer
    known = ledger.stored_schemas(spark, out, DAYS)
    assert set(known) == set(DAYS[:2])
    got = sorted(map(tuple, read_partitioned(spark, out, column="d").select("d", "id", "s.a", "s.b", "more").collect()), key=str)
    want = [(DAYS[0], str(k), 1, None, None) for k in range(3)] + [(DAYS[1], str(k), None, "x", None) for k in range(4)] + [(DAYS[2], None, None, None, 2.5)] * 2
    assert got == sorted(want, key=str)
    # a broken write leaves its mark: nothing is trusted, and the result is the same
    ledger.open_write(spark, out)
    assert ledger.stored_schemas(spark, out, DAYS) == {}
    assert read_partitioned(spark, out, [DAYS[1]], "d").count() == 4
    assert sorted(map(tuple, read_partitioned(spark, out, column="d").select("d", "id", "s.a", "s.b", "more").collect()), key=str) == got
    ledger.settle(spark, out)
    write_partitioned(spark.range(1).select(day(0), "id"), out, "d")
    assert set(ledger.stored_schemas(spark, out, DAYS)) == {DAYS[0]} and read_partitioned(spark, out, DAYS[:1], "d").columns == ["id", "d"]


def test_conflicting_exports_take_the_same_jobs_whatever_their_number(spark, tmp_dir):
    raw = TD.raw_events(spark, SF_SMALL).limit(2)
    days = [dt.date(2024, 2, d) for d in range(1, 10)]
    for k, d in enumerate(days):
        flag = F.col("privacy_info.analytics_storage").cast(("bigint", "int", "string")[k % 3])
        raw.withColumn("privacy_info", F.col("privacy_info").withField("analytics_storage", flag)).withColumn(f"only_{k}", F.lit(k)) \
            .write.parquet(f"{tmp_dir}/raw/{raw_file_name(d)}")
    jobs = []
    for some in (days[:3], days):
        spark.sparkContext.setJobGroup(f"conflict-{len(some)}", "")
        got = read_days(spark, f"{tmp_dir}/raw", some)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"conflict-{len(some)}")))
        spark.sparkContext.setJobGroup("rest", "")
        assert got.count() == 2 * len(some) and {f"only_{k}" for k in range(len(some))} <= set(got.columns)
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3  # a scan for each type
    assert jobs[0] == jobs[1]
    found = footer_schemas(spark, [f"{tmp_dir}/raw/{raw_file_name(d)}" for d in days] + ["viewfs://nowhere/x"][:0])
    assert len({f for f, _ in found}) == len(found) >= 9


def test_exports_are_scanned_once(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw")
    start, _ = _scans(spark, 0, "nothing")
    run_base(spark, f"{tmp_dir}/raw", f"{tmp_dir}/base")
    _, plans = _scans(spark, start, f"{tmp_dir}/raw")
    assert len(plans) == 1 and len(re.findall(r"\n\(\d+\) Scan parquet", plans[0])) == 1


def test_a_batch_is_shuffled_once(spark, tmp_dir, monkeypatch):
    from clickmodel.plans import jobs
    _land(spark, f"{tmp_dir}/raw")
    text = F.to_json(F.struct("*"))
    stored = lambda out: sorted(r[0] for r in read_partitioned(spark, out).select(text).collect())
    shuffles = {}
    for limit in (len(DAYS), len(DAYS) - 1):  # a batch within the limit, and one beyond it
        monkeypatch.setattr(jobs, "DEALT_DAYS", limit)
        start, _ = _scans(spark, 0, "nothing")
        report = run_base(spark, f"{tmp_dir}/raw", f"{tmp_dir}/base{limit}").collect()
        assert [(r.date, r.written) for r in report] == [(d, True) for d in DAYS]
        _, plans = _scans(spark, start, f"{tmp_dir}/raw")
        shuffles[limit] = plans[0].partition("== Initial Plan ==")[0].count("- Exchange (")
    assert shuffles == {len(DAYS): 1, len(DAYS) - 1: 2}
    assert stored(f"{tmp_dir}/base{len(DAYS)}") == stored(f"{tmp_dir}/base{len(DAYS) - 1}") != []


def test_dealt_rows_are_written_by_their_own_tasks(spark, tmp_dir):
    from clickmodel.operators.dedup import dedup_events
    param = "array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>"
    rows = spark.range(400).selectExpr("CASE WHEN id % 5 > 0 THEN date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) END AS event_date_dt", "id % 7 AS stream_id",
                                       "CASE WHEN id % 3 > 0 THEN 'u' END AS user_pseudo_id", "id % 4 AS session_id", "'e' AS event_name", "id % 40 AS event_timestamp",
                                       f"CASE WHEN id % 11 > 0 THEN CAST(array() AS {param}) END AS event_params")
    rows = rows.unionByName(rows)
    plain, led = dedup_events(rows), dedup_events(rows, lead=["event_date_dt"])
    in_order = lambda x: sorted(map(str, x.collect()))
    assert in_order(led) == in_order(plain) and led.columns == plain.columns
    days = write_partitioned(led.where("event_date_dt IS NOT NULL"), f"{tmp_dir}/out", "event_date_dt", dealt=True)
    assert days == DAYS[:2]
    again = led.where("event_date_dt = '2024-01-02'").withColumn("event_name", F.lit("f"))
    assert write_partitioned(again, f"{tmp_dir}/out", "event_date_dt", dealt=True) == [DAYS[1]]
    counts = {(r.event_date_dt, r.event_name): r["count"] for r in read_partitioned(spark, f"{tmp_dir}/out").groupBy("event_date_dt", "event_name").count().collect()}
    want = {r.event_date_dt: r["count"] for r in plain.groupBy("event_date_dt").count().collect()}
    assert counts == {(DAYS[0], "e"): want[DAYS[0]], (DAYS[1], "f"): want[DAYS[1]]}


def test_a_batch_of_copies_rewrites_nothing(spark, tmp_dir):
    raw, base = f"{tmp_dir}/raw", f"{tmp_dir}/base"
    rows = _land(spark, raw, DAYS[:1])
    run_base(spark, raw, base)
    before = _files(base)
    copies = rows.where("event_date = '20240101'").limit(40)
    copies.unionByName(rows.where("event_date = '20240102'")).coalesce(1).write.parquet(f"{raw}/{raw_file_name(DAYS[1])}")
    rep = {r.date: r for r in run_base(spark, raw, base).collect()}
    assert not rep[DAYS[0]].written and rep[DAYS[1]].written
    after = _files(base)
    assert {f: t for f, t in after.items() if f in before} == before and not any(str(DAYS[0]) in f for f in set(after) - set(before))
    # one new event among copies: that day alone is written, with one row more
    n = read_partitioned(spark, base, DAYS[:1]).count()
    new = copies.limit(1).withColumn("event_timestamp", F.col("event_timestamp") + 7)
    copies.unionByName(new).unionByName(new).coalesce(1).write.parquet(f"{raw}/{raw_file_name(DAYS[2])}")
    rep = {r.date: r for r in run_base(spark, raw, base).collect()}
    assert rep[DAYS[0]].written and rep[DAYS[0]].n_rows == n + 1 == read_partitioned(spark, base, DAYS[:1]).count()
    assert {f for f in _files(base) if str(DAYS[1]) in f} == {f for f in after if str(DAYS[1]) in f}
    assert not os.path.exists(f"{base}/_late")


def test_stale_digests_are_made_anew(spark, tmp_dir):
    raw, base = f"{tmp_dir}/raw", f"{tmp_dir}/base"
    rows = _land(spark, raw, DAYS[:1])
    run_base(spark, raw, base)
    late = rows.where("event_date = '20240101'").limit(5)
    late.withColumn("event_timestamp", F.col("event_timestamp") + 1).coalesce(1).write.parquet(f"{raw}/{raw_file_name(DAYS[1])}")
    run_base(spark, raw, base)
    n = read_partitioned(spark, base, DAYS[:1]).count()
    digests = spark.createDataFrame(spark.read.parquet(f"{base}/_digests").limit(3).collect())
    write_partitioned(digests, f"{base}/_digests", "event_date_dt")  # as if a run had broken off between data and digests
    late.coalesce(1).write.parquet(f"{raw}/{raw_file_name(DAYS[2])}")
    rep = {r.date: r for r in run_base(spark, raw, base).collect()}
    assert not rep[DAYS[0]].written and read_partitioned(spark, base, DAYS[:1]).count() == n == spark.read.parquet(f"{base}/_digests").count()


def test_digests_tell_nulls_and_members_apart(spark):
    from clickmodel.operators.dedup import DEDUP_KEYS
    from clickmodel.plans.jobs import DIGEST, _digested
    param = "event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>"
    schema = "event_date_dt date, stream_id bigint, user_pseudo_id string, session_id bigint, event_name string, event_timestamp bigint, " + param
    rows = [(DAYS[0], 1, "u", 2, "e", 3, p) for p in ([("a", (None, None)), ("b", ("x", None))], [("a", ("b", None)), ("x", (None, None))], [], None, [("a", None)])]
    rows += [(DAYS[0], None, "u", 2, "e", 3, []), (DAYS[0], 1, None, 2, "e", 3, []), (DAYS[0], 1, "u", 2, None, 3, []), (None, 1, "u", 2, "e", 3, [])]
    df = spark.createDataFrame(rows, schema)
    assert df.columns == [*DEDUP_KEYS, "event_params"]
    assert len({tuple(r) for r in _digested(df).select(*DIGEST).collect()}) == len(rows)
    # an export with one more member, NULL throughout, has the same digests
    wider = df.withColumn("event_params", F.transform("event_params", lambda p: p.withField("value", F.when(
        p["value"].isNotNull(), F.struct(p["value"]["string_value"].alias("string_value"), p["value"]["int_value"].alias("int_value"), F.lit(None).cast("double").alias("double_value"))))))
    assert sorted(map(tuple, _digested(wider).select(*DIGEST).collect())) == sorted(map(tuple, _digested(df).select(*DIGEST).collect()))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from clickmodel.session import shared_folder
    unset = SimpleNamespace(get=lambda k, d=None: d)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="spark://host:7077")))


def _staged(spark, rows):
    from clickmodel.operators.base import base_events
    from clickmodel.operators.staging import stage_events
    one = stage_events(base_events(TD.raw_events(spark, SF_SMALL).limit(1)))
    events = F.array(*[F.struct(F.lit(str(d)).cast("date").alias("event_date_dt"), F.lit(k).cast("string").alias("session_key"),
                                F.lit(t).cast("bigint").alias("event_timestamp")) for d, k, t in rows])
    return one.drop("event_date_dt", "session_key", "event_timestamp").withColumn("e", F.explode(events)).select("*", "e.*").drop("e") \
        .withColumns({"event_name": F.lit("click"), "event_key": F.concat_ws("-", "session_key", "event_timestamp")})


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2)])
def test_a_session_over_midnight_has_one_row(spark, tmp_dir, order):
    rows = [(DAYS[0], "a", 1), (DAYS[1], "a", 2), (DAYS[1], "b", 3), (DAYS[2], "b", 4), (DAYS[2], "a", 5), (DAYS[2], "c", 6), (DAYS[2], None, 7)]
    _staged(spark, rows).write.partitionBy("event_date_dt").parquet(f"{tmp_dir}/stg")
    for k in order:
        run_sessions(spark, f"{tmp_dir}/stg", None, f"{tmp_dir}/plain", start=DAYS[k])
        run_sessions(spark, f"{tmp_dir}/stg", None, f"{tmp_dir}/ses", start=DAYS[k], look_back=2)
    got = lambda x: sorted(((r.session_start_date, r.session_key, r.session_start_timestamp) for r in read_partitioned(spark, f"{tmp_dir}/{x}", column="session_start_date").collect()), key=str)
    assert len(got("plain")) == 7
    assert got("ses") == sorted([(DAYS[0], "a", 1), (DAYS[1], "b", 3), (DAYS[2], "c", 6), (DAYS[2], None, 7)], key=str)


def test_the_load_evaluates_its_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(500, numPartitions=4).selectExpr("CAST(id AS STRING) AS event_key", "id AS v").mapInPandas(count, "event_key string, v bigint")
    load_warehouse(df, path=f"{tmp_dir}/csv", staging=f"{tmp_dir}/staging")
    assert seen.value == 500 and os.listdir(f"{tmp_dir}/staging") == []
    assert spark.read.option("header", "true").csv(f"{tmp_dir}/csv").count() == 500
    with pytest.raises(ValueError, match="event_key"):
        load_warehouse(df.unionAll(df.limit(1)), path=f"{tmp_dir}/csv", staging=f"{tmp_dir}/staging")
    assert spark.read.option("header", "true").csv(f"{tmp_dir}/csv").count() == 500 and os.listdir(f"{tmp_dir}/staging") == []


def test_only_heavy_right_keys_are_salted(spark):
    left = spark.range(300).selectExpr("CASE WHEN id % 50 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE CAST(id AS STRING) END AS k", "id AS l")
    right = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 2000 AS STRING) END AS k", "id % 4 AS r")
    plain = sorted(map(tuple, left.join(right, "k", "left").select("k", "l", "r").collect()), key=str)
    split = left_join(left, right, "k", repeated_keys=True, salt_rows=100)
    assert sorted(map(tuple, split.select("k", "l", "r").collect()), key=str) == plain and split.columns == ["k", "l", "r"]
    parts = split.where("k = 'hot'").select(F.xxhash64("r", F.spark_partition_id())).distinct().count()
    assert parts > 4  # the hot key's rows come from several tasks
    tree = split._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("Range (0, 300") == 1  # the left side is planned once
