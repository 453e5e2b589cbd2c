"""DataFrame operators: edge rows from the fixture notes."""

import datetime as dt

from pyspark.sql import functions as F

from clickmodel.operators import (date_window, date_window_exact, dedup_events, drop_boundary_events,
                                  explode_items, collect_items, first_event_per_session, left_join,
                                  normalize_items, serving_projection, stage_events, unnest_key, user_snapshot)
from clickmodel.operators.base import base_events
from clickmodel.operators.serving import SERVING_COLUMNS
from clickmodel.operators.staging import gclid_attribution
from clickmodel.schema import ITEMS, PARAMS
from clickmodel.sources import testdata as TD

from conftest import SF_SMALL


def test_normalize_items_edge_cases(spark):
    rows = [(1, [("a", 1, 1.5), None]), (2, []), (3, None), (4, [("b", 2, 2.0)])]
    df = spark.createDataFrame(rows, f"id int, items {ITEMS.simpleString()}")
    got = {r.id: [tuple(x) for x in r.items] for r in normalize_items(df).collect()}
    null_item = (None, None, None)
    assert got == {1: [("a", 1, 1.5), null_item], 2: [null_item], 3: [null_item], 4: [("b", 2, 2.0)]}
    kept = {r.id: r.items for r in normalize_items(df, keep_empty=True).collect()}
    assert kept[2] == [] and kept[3] is None


def test_normalize_items_noop_when_not_struct(spark):
    df = spark.createDataFrame([(1, ["x"])], "id int, items array<string>")
    assert normalize_items(df).collect() == df.collect()


def test_explode_collect_roundtrip(spark):
    rows = [(1, [("a", 1, 1.0), ("b", 2, 2.0)]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, f"id int, items {ITEMS.simpleString()}")
    x = explode_items(df)
    assert x.count() == 4
    back = {r.id: [tuple(i) for i in r.items] for r in collect_items(x, ["id"]).collect()}
    assert back == {1: [("a", 1, 1.0), ("b", 2, 2.0)], 2: [], 3: []}


def test_unnest_key_repeats_and_missing(spark):
    rows = [(1, [("k", ("A", None)), ("k", ("B", None))]), (2, [("other", ("x", None))]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, f"id int, event_params {PARAMS.simpleString()}")
    got = sorted((r.id, r.k) for r in unnest_key(df, "event_params", "k", "lower_string_value").collect())
    assert got == [(1, "a"), (1, "b"), (2, None), (3, None), (4, None)]
    assert "event_params" in unnest_key(df, "event_params", "k").columns


def _raw_small(spark):
    return TD.raw_events(spark, SF_SMALL, with_items=True)


def test_dedup_drops_exact_copies_only(spark):
    raw = _raw_small(spark)
    flat = base_events(raw, keep=["event_bundle_sequence_id"])
    n_ids = raw.select("event_bundle_sequence_id").distinct().count()
    assert raw.count() > n_ids
    assert dedup_events(flat).count() == n_ids


def test_dedup_deterministic_survivor(spark):
    schema = ("event_date_dt date, stream_id long, user_pseudo_id string, session_id long, event_name string, "
              f"event_timestamp long, event_params {PARAMS.simpleString()}, payload string")
    d = dt.date(2024, 1, 1)
    rows = [(d, 1, "u", 1, "e", 10, [("k", ("v", None))], "zzz"), (d, 1, "u", 1, "e", 10, [("k", ("v", None))], "aaa"),
            (d, 1, "u", 1, "e", 10, [("k", ("w", None))], "mmm"), (d, 1, "u", None, "e", 10, None, "n1"),
            (d, 1, "u", None, "e", 10, None, "n0")]
    df = spark.createDataFrame(rows, schema)
    out = sorted(r.payload for r in dedup_events(df, order=["payload"]).collect())
    assert out == ["aaa", "mmm", "n0"]
    # by default two hashes of the row decide: the same survivors however the rows are dealt out
    runs = {tuple(sorted(r.payload for r in dedup_events(df.repartition(n)).collect())) for n in (1, 2, 5)}
    assert len(runs) == 1 and len(runs.pop()) == 3


def test_dedup_keeps_events_that_differ_in_an_undeclared_value_type(spark):
    from clickmodel.operators.base import base_model
    raw = TD.raw_events(spark, SF_SMALL, duplicates=False).limit(1)
    value = "named_struct('key', 'score', 'value', named_struct('string_value', CAST(NULL AS STRING), 'int_value', CAST(NULL AS BIGINT), 'double_value', {}))"
    two = raw.withColumn("event_params", F.expr(f"array({value.format('1.5D')})")).unionByName(
        raw.withColumn("event_params", F.expr(f"array({value.format('2.5D')})")))
    assert base_model(two).count() == 2 and base_model(two.unionByName(two)).count() == 2


def test_base_model_shuffles_raw_rows_once(spark):
    from clickmodel.operators.base import base_model
    raw = spark.createDataFrame(TD.raw_events(spark, SF_SMALL).limit(5).collect(), TD.raw_events(spark, SF_SMALL).schema)
    plan = base_model(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    sort = next(line for line in plan.splitlines() if " Sort [" in line)
    assert sort.count(" ASC ") <= 9
    shuffled = plan[plan.index("Exchange hashpartitioning"):]
    assert "page_title" not in shuffled.split("Project [")[0]


def test_first_event_per_session_ties(spark):
    df = spark.createDataFrame([("s", 5, "k2"), ("s", 5, "k1"), ("s", 9, "k0"), ("t", 1, "x")],
                               "session_key string, event_timestamp long, event_key string")
    got = sorted(tuple(r) for r in first_event_per_session(df).collect())
    assert got == [("s", 5, "k1"), ("t", 1, "x")]


def test_drop_boundary_events_drops_null_names(spark):
    df = spark.createDataFrame([("first_visit",), ("session_start",), ("page_view",), (None,)], "event_name string")
    assert [r.event_name for r in drop_boundary_events(df).collect()] == ["page_view"]


def test_date_windows(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    df = spark.createDataFrame([(d,) for d in days], "event_date_dt date")
    assert date_window(df, "2024-01-03", 3).count() == 3
    assert date_window(df, "2024-01-03").count() == 8
    assert date_window_exact(df, "2024-01-03").count() == 1
    assert date_window(df, "2024-01-03", 2, direction="back").count() == 2
    assert date_window(df).count() == 10


def test_left_join_with_repeated_keys_matches_plain(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, l int")
    right = spark.createDataFrame([("a", "x")] * 50 + [("b", "y"), ("b", "z"), (None, "n")], "k string, r string")
    plain = sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    for repeated in (True, False):
        got = sorted(map(tuple, left_join(left, right, "k", repeated).select("k", "l", "r").collect()), key=str)
        assert got == plain


def test_left_join_hot_right_key_starts_no_job_when_built(spark):
    tracker = spark.sparkContext.statusTracker()
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id AS l")
    right = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id AS r")
    spark.sparkContext.setJobGroup("build-join", "")
    plain, split = left_join(left, right, "k"), left_join(left, right, "k", repeated_keys=True)
    assert tracker.getJobIdsForGroup("build-join") == []
    spark.sparkContext.setJobGroup("run-join", "")
    assert plain.count() == split.count() == 1000 * 300 + 2000


def test_gclid_attribution_rules(spark):
    rows = [("https://a.com/?gclid=1", None, None, None), ("https://a.com/?gclid=1", "bing", "organic", "(organic)"),
            ("https://a.com/?gclid=1", "x", "email", "spring"), (None, None, None, None),
            ("https://a.com/", None, "organic", "organic")]
    df = spark.createDataFrame(rows, "page_location string, event_source string, event_medium string, "
                                     "event_campaign string")
    got = [tuple(r)[1:] for r in gclid_attribution(df).collect()]
    assert got == [("google", "cpc", "(cpc)"), ("bing", "cpc", "(cpc)"), ("x", "email", "spring"),
                   (None, None, None), (None, "organic", "organic")]


def test_staged_and_serving_shapes(spark):
    flat = base_events(_raw_small(spark))
    assert len(flat.columns) == 57
    staged = stage_events(dedup_events(flat))
    assert staged.columns[0] == "event_date_dt" and len(staged.columns) == 68
    serving = serving_projection(staged)
    assert serving.columns == [c for c, _ in SERVING_COLUMNS] and len(serving.columns) == 68
    assert dict(serving.dtypes)["ecommerce"] == "string"


def test_url_mode_encoded_reproduces_whole_path(spark):
    flat = base_events(_raw_small(spark))
    s = stage_events(dedup_events(flat), url_mode="encoded").where(F.col("page_location").isNotNull())
    r = s.select("page_path", "page_hostname", "original_page_location").first()
    assert r.page_hostname is None and r.page_path == r.original_page_location


def test_user_snapshot_columns(spark):
    u = user_snapshot(TD.user_snapshot_raw(spark, SF_SMALL))
    assert "device_unified_sceen_name" in u.columns and len(u.columns) == 28
    assert dict(u.dtypes)["occurrence_date"] == "date"
    assert u.where("occurrence_date is null").count() >= 1   # malformed text -> NULL, job survives


def test_dedup_with_hot_copy_group(spark):
    # one exact event delivered 20,000 times next to 40,000 distinct events (a third of all rows)
    cols = ("CAST('2024-01-01' AS DATE) AS event_date_dt", "1L AS stream_id", "'u' AS user_pseudo_id",
            "7L AS session_id", "'page_view' AS event_name")
    hot = spark.range(20000).selectExpr(*cols, "100L AS event_timestamp",
                                        "array(named_struct('key', 'k', 'value', named_struct('string_value', 'v', "
                                        "'int_value', CAST(NULL AS BIGINT)))) AS event_params")
    rest = spark.range(40000).selectExpr(*cols, "id + 1000 AS event_timestamp",
                                         "array(named_struct('key', 'k', 'value', named_struct('string_value', 'v', "
                                         "'int_value', id))) AS event_params")
    df = hot.unionByName(rest).repartition(8)
    out = dedup_events(df)
    assert out.count() == 40001
    assert out.where("event_timestamp = 100").count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
