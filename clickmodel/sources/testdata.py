"""Adapter: raw nested event rows (and side tables) built from the driver's test tables.

Everything here is derived by Spark from ``events``, ``pages``, ``lineitem``, ``customer`` and
``nation``, so the work grows with the tables. The same rules are written as DuckDB SQL in
``clickmodel.oracle`` (keep the two in step).

Mapping: user_pseudo_id/stream_id from user_id; event_date/event_timestamp from ts; event
names from event_type (``view`` -> ``' Page View '`` for even ids, else ``page_view``;
``signup`` -> ``first_visit``; ``error`` -> ``session_start``); page_location from ``pages``
(``page_id = event_id % count(pages)``) with a click id on every 7th event and a space (an
invalid URI) on ids = 25 mod 50; ga_session_id = day number; session_number = dense rank of
the day among the user's days; items = the ``lineitem`` rows of order ``event_id``; every
10th event is delivered twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmodel.functions.keys import hash_key

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's read-only table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(expr: str, mapping: dict, default: str | None = None) -> str:
    """SQL ``CASE`` over literal values (fixture rules are written as SQL text: one JVM call
    per column instead of one per sub-expression)."""
    whens = " ".join(f"WHEN {expr} = {k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens}{f' ELSE {default}' if default else ''} END"


def _param(key: str, s: str = "NULL", i: str = "NULL", present: str | None = None) -> str:
    k = f"'{key}'" if present is None else f"CASE WHEN {present} THEN '{key}' END"
    return (f"named_struct('key', {k}, 'value', named_struct('string_value', CAST({s} AS STRING), "
            f"'int_value', CAST({i} AS BIGINT)))")


def day_number(ts: str = "ts") -> Column:
    return F.unix_date(F.col(ts).cast("date")).cast("long")


def user_days(events: DataFrame) -> DataFrame:
    """(user_id, day, session_number). Ranked over distinct user-days, so a user with a
    huge share of events still contributes at most one row per active day."""
    ud = events.select("user_id", day_number().alias("day")).distinct()
    w = Window.partitionBy("user_id").orderBy("day")
    return ud.withColumn("session_number", F.dense_rank().over(w).cast("long"))


def items_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, items): the line items of each order, in line-number order (ties broken by
    the item fields, so the array is deterministic)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                 "l_extendedprice")
    item = F.struct(F.col("l_partkey").cast("string").alias("item_id"),
                    F.col("l_quantity").cast("long").alias("quantity"),
                    F.col("l_extendedprice").alias("price"))
    agg = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), item.alias("it")))).alias("a"))
    return agg.select(F.col("l_orderkey").alias("event_id"), F.transform("a", lambda x: x["it"]).alias("items"))


NULL_S, NULL_L, NULL_D = "CAST(NULL AS STRING)", "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
ITEM_SQL = "STRUCT<item_id: STRING, quantity: BIGINT, price: DOUBLE>"


def _raw_columns(with_items: bool) -> list[str]:
    e, u = "event_id", "user_id"
    params = ", ".join([
        _param("page_location", s="loc", present=f"{e} % 40 <> 39"),
        _param("ga_session_id", i="day"),
        _param("ga_session_number", i="session_number"),
        _param("engagement_time_msec", i=f"({e} * 37) % 10000", present=f"{e} % 6 <> 5"),
        _param("page_title", s="concat('Page ', CAST(page_id AS STRING))"),
        _param("page_referrer", s="ref", present=f"{e} % 3 <> 0"),
        _param("source", s=_case(f"{e} % 5", {0: "Google", 1: "bing", 2: "(Direct)"}), present=f"{e} % 5 <> 4"),
        _param("medium", s=_case(f"{e} % 4", {0: "Organic", 1: "CPC", 2: "referral"}), present=f"{e} % 4 <> 3"),
        _param("campaign", s=_case(f"{e} % 6", {0: "(organic)", 1: "Spring_Sale", 2: "organic", 3: "(ORGANIC)"}),
               present=f"{e} % 6 <> 5"),
        _param("content", s="'Banner_A'", present=f"{e} % 7 = 1"),
        _param("term", s="'Running Shoes'", present=f"{e} % 9 = 2"),
        _param("session_engaged", s=_case(f"{e} % 4", {1: "1", 2: "0"}), i=f"CASE WHEN {e} % 4 = 0 THEN 1 END",
               present=f"{e} % 4 <> 3"),
        _param("page_title", s="'Duplicate title'", present=f"{e} % 13 = 0"),
    ])
    if with_items:
        items = (f"CASE WHEN {e} % 11 = 0 THEN CAST(array() AS ARRAY<{ITEM_SQL}>) "
                 f"WHEN {e} % 23 = 0 THEN concat(items, array(CAST(NULL AS {ITEM_SQL}))) ELSE items END")
    else:
        items = f"CAST(NULL AS ARRAY<{ITEM_SQL}>)"
    purchase = "event_type = 'purchase'"
    return [
        "date_format(ts, 'yyyyMMdd') AS event_date",
        f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, ts) AS event_timestamp",
        "CASE WHEN event_type = 'view' THEN (CASE WHEN event_id % 2 = 0 THEN ' Page View ' ELSE 'page_view' END) "
        "WHEN event_type = 'signup' THEN 'first_visit' WHEN event_type = 'error' THEN 'session_start' "
        "ELSE event_type END AS event_name",
        f"filter(array({params}), x -> x.key IS NOT NULL) AS event_params",
        f"{NULL_L} AS event_previous_timestamp",
        f"CASE WHEN {purchase} THEN value END AS event_value_in_usd",
        f"{e} AS event_bundle_sequence_id",
        f"{e} % 1000 AS event_server_timestamp_offset",
        f"CASE WHEN {u} % 5 = 0 THEN concat('u', CAST({u} AS STRING)) END AS user_id",
        f"concat(CAST({u} AS STRING), '.1704067200') AS user_pseudo_id",
        f"named_struct('analytics_storage', CAST({u} % 2 AS INT), 'ads_storage', CASE WHEN {u} % 5 <> 0 THEN 1 END, "
        "'uses_transient_token', 'No') AS privacy_info",
        f"array({_param('plan', s=f'CASE WHEN {u} % 2 = 0 THEN {chr(39)}free{chr(39)} ELSE {chr(39)}pro{chr(39)} END')})"
        " AS user_properties",
        f"1704067200000000 - {u} * 1000000 AS user_first_touch_timestamp",
        f"named_struct('revenue', CAST({u} AS DOUBLE) * CAST(0.5 AS DOUBLE), 'currency', 'USD') AS user_ltv",
        "named_struct("
        f"'category', {_case(f'{u} % 3', {0: 'desktop', 1: 'mobile', 2: 'tablet'})}, "
        f"'mobile_brand_name', {_case(f'{u} % 3', {1: 'Apple', 2: 'Samsung'})}, "
        f"'mobile_model_name', {_case(f'{u} % 3', {1: 'iPhone', 2: 'Galaxy Tab'})}, "
        f"'mobile_marketing_name', {NULL_S}, 'mobile_os_hardware_model', {NULL_L}, "
        f"'operating_system', {_case(f'{u} % 3', {0: 'Windows', 1: 'iOS', 2: 'Android'})}, "
        f"'operating_system_version', concat('v', CAST({u} % 10 AS STRING)), "
        f"'vendor_id', {NULL_L}, 'advertising_id', {NULL_L}, "
        f"'language', {_case(f'{u} % 4', {0: 'en-us', 1: 'fr-fr', 2: 'de-de', 3: 'es-es'})}, "
        f"'is_limited_ad_tracking', 'No', 'time_zone_offset_seconds', {NULL_L}) AS device",
        "named_struct("
        f"'continent', {_case(f'{u} % 3', {0: 'Americas', 1: 'Europe', 2: 'Asia'})}, "
        f"'country', {_case(f'{u} % 4', {0: 'United States', 1: 'France', 2: 'Germany', 3: 'Japan'})}, "
        f"'region', concat('R', CAST({u} % 7 AS STRING)), 'city', concat('City ', CAST({u} % 11 AS STRING)), "
        f"'sub_continent', {NULL_S}, 'metro', '(not set)') AS geo",
        f"named_struct('id', {NULL_S}, 'version', {NULL_S}, 'install_store', {NULL_S}, 'firebase_app_id', {NULL_S}, "
        f"'install_source', {NULL_S}) AS app_info",
        "named_struct("
        f"'name', {_case(f'{u} % 3', {0: '(direct)', 1: 'spring_sale', 2: '(organic)'})}, "
        f"'medium', {_case(f'{u} % 3', {0: '(none)', 1: 'cpc', 2: 'organic'})}, "
        f"'source', {_case(f'{u} % 3', {0: '(direct)', 1: 'google', 2: 'google'})}) AS traffic_source",
        f"1000 + {u} % 3 AS stream_id",
        "'WEB' AS platform",
        f"CASE WHEN {purchase} THEN named_struct('total_item_quantity', {e} % 5 + 1, "
        "'purchase_revenue_in_usd', value, 'purchase_revenue', value, "
        f"'refund_value_in_usd', {NULL_D}, 'refund_value', {NULL_D}, 'shipping_value_in_usd', CAST(0.0 AS DOUBLE), "
        f"'shipping_value', CAST(0.0 AS DOUBLE), 'tax_value_in_usd', {NULL_D}, 'tax_value', {NULL_D}, "
        f"'unique_items', {e} % 3 + 1, 'transaction_id', concat('T', CAST({e} AS STRING))) END AS ecommerce",
        f"{items} AS items",
    ]


def raw_events(spark: SparkSession, sf_dir: str, with_items: bool = True, duplicates: bool = True) -> DataFrame:
    """Raw daily export rows (schema ``clickmodel.schema.RAW_EVENT``)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.select(F.count(F.lit(1))).scalar()

    e = (ev.withColumn("day", day_number()).withColumn("page_id", F.col("event_id") % n_pages)
         .join(pages, "page_id", "left")
         .join(user_days(ev), ["user_id", "day"], "left"))
    if with_items:
        e = e.join(items_by_order(spark, sf_dir), "event_id", "left")
    e = e.selectExpr(
        "*",
        "CASE WHEN event_id % 50 = 25 THEN concat(url, '/my page') ELSE url END AS url1",
        "concat('https://ref.example.com/p', CAST(event_id % 17 AS STRING), "
        "CASE WHEN event_id % 5 = 0 THEN '?utm_source=news&parameter=x' ELSE '' END) AS ref")
    e = e.selectExpr("*", "CASE WHEN event_id % 7 = 0 THEN concat(url1, CASE WHEN instr(url1, '?') > 0 THEN '&' "
                          "ELSE '?' END, 'gclid=', CAST(event_id AS STRING)) ELSE url1 END AS loc")
    out = e.selectExpr(*_raw_columns(with_items))
    if duplicates:
        # Every 10th event is delivered twice (exact copy), without a second scan.
        out = out.withColumn("__copy", F.explode(F.expr(
            "CASE WHEN event_bundle_sequence_id % 10 = 0 THEN array(1, 2) ELSE array(1) END"))).drop("__copy")
    return out


def _case_col(expr: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(expr == k, F.lit(v)) if out is None else out.when(expr == k, F.lit(v))
    return out


def _param_col(key: str, s: Column) -> Column:
    return F.struct(F.lit(key).alias("key"),
                    F.struct(s.cast("string").alias("string_value"), F.lit(None).cast("long").alias("int_value"))
                    .alias("value"))


def session_key_of(user_id: str = "user_id", day: str = "day") -> Column:
    """Session key of a (user, day) session under the mapping above (same rules as staging)."""
    pseudo = F.concat(F.col(user_id).cast("string"), F.lit(".1704067200"))
    stream = F.lit(1000) + F.col(user_id) % 3
    return hash_key(hash_key(pseudo, stream), F.col(day))


def traffic_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, day) session of every user. Odd users' rows are keyed to a day far
    outside the data (day + 100000), so their sessions find no traffic row and exercise the
    left join's NULLs while every input row still flows through."""
    ev = table(spark, sf_dir, "events")
    u = F.col("user_id") % 3
    sessions = ev.select("user_id", day_number().alias("day")).distinct()
    key_day = F.when(F.col("user_id") % 2 == 0, F.col("day")).otherwise(F.col("day") + 100000)
    return sessions.withColumn("key_day", key_day).select(
        session_key_of(day="key_day").alias("session_key"),
        _case_col(u, {0: "google", 1: "bing", 2: "direct"}).alias("session_source"),
        _case_col(u, {0: "cpc", 1: "organic", 2: "(none)"}).alias("session_medium"),
        F.concat(F.lit("camp_"), (F.col("user_id") % 4).cast("string")).alias("session_campaign"))


def derived_session_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-session aggregates (one bigint, one string), partially aggregated before the shuffle."""
    ev = table(spark, sf_dir, "events").withColumn("day", day_number())
    agg = ev.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("session_event_count"),
                                           F.max("event_type").alias("session_last_event_type"))
    return agg.select(session_key_of().alias("session_key"), "session_event_count", "session_last_event_type")


def user_snapshot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw user-snapshot rows from ``customer`` joined to ``nation``."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"),
                                               F.col("c_nationkey") == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    day_text = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 30).cast("int")), "yyyyMMdd")
    return c.select(
        k.alias("c_custkey"),
        F.struct((F.lit(1704067200000000) + k * 1000).alias("last_active_timestamp_micros"),
                 (F.lit(1704067200000000) - k * 1000000).alias("user_first_touch_timestamp_micros"),
                 F.when(k % 3 != 0, F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")))
                 .alias("first_purchase_date")).alias("user_info"),
        F.struct(_case_col(k % 3, {0: "Windows", 1: "iOS", 2: "Android"}).alias("operating_system"),
                 F.lower(F.col("c_mktsegment")).alias("category"),
                 _case_col(k % 3, {1: "Apple", 2: "Google"}).alias("mobile_brand_name"),
                 _case_col(k % 3, {1: "iPhone", 2: "Pixel"}).alias("mobile_model_name"),
                 F.concat(F.lit("screen_"), (k % 5).cast("string")).alias("unified_screen_name")).alias("device"),
        F.struct(F.concat(F.lit("City "), (k % 50).cast("string")).alias("city"), F.col("n_name").alias("country"),
                 _case_col(F.col("n_regionkey"), {0: "Africa", 1: "Americas", 2: "Asia", 3: "Europe", 4: "Middle East"})
                 .alias("continent"),
                 F.col("n_regionkey").cast("string").alias("region")).alias("geo"),
        F.struct(F.col("c_acctbal").alias("revenue_in_usd"), (k % 20).alias("sessions"),
                 (k * 1000).alias("engagement_time_millis"), (k % 5).alias("purchases"),
                 (k % 10).alias("engaged_sessions"), (k * 1000000).alias("session_duration_micros")).alias("user_ltv"),
        F.struct(*[((k % m).cast("double") / F.lit(float(m))).alias(n) for n, m in
                   (("in_app_purchase_score_7d", 100), ("purchase_score_7d", 50), ("churn_score_7d", 20),
                    ("revenue_28d_in_usd", 8))]).alias("predictions"),
        F.struct(F.when(k % 2 == 0, F.lit("No")).otherwise(F.lit("Yes")).alias("is_limited_ad_tracking"),
                 F.when(k % 3 != 0, F.lit("Yes")).alias("is_ads_personalization_allowed")).alias("privacy_info"),
        F.when(k % 97 == 0, F.lit("2024-13-45")).otherwise(day_text).alias("occurrence_date"),
        F.lit("20240131").alias("last_updated_date"),
        F.array(_param_col("segment", s=F.col("c_mktsegment"))).alias("user_properties"),
        F.array(F.struct(F.col("c_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")))
        .alias("audiences"),
    )


def land_exports(spark: SparkSession, raw: DataFrame, root: str, day: str = "event_date") -> None:
    """Writes raw rows as one export per value of ``day`` (YYYYMMDD): ``events_YYYYMMDD.parquet``
    folders, the landing zone's form. All of a call's days are written by one job."""
    from clickmodel.sources.fs import file_system, list_names
    staging = f"{root}/__landing-{uuid.uuid4().hex}"
    raw.withColumn("__day", F.col(day)).write.partitionBy("__day").parquet(staging)
    path, fs = file_system(spark, root)
    for name in list_names(spark, staging):
        if name.startswith("__day="):
            target = f"{root}/events_{name[len('__day='):]}.parquet"
            fs.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/{name}"), spark._jvm.org.apache.hadoop.fs.Path(target))
