"""Registered queries: one per operator of the model, each a Spark plan over the driver's
tables with an independent DuckDB SQL twin (``clickmodel.oracle``) for the correctness gate.

Outputs are scalar columns (dates as ISO text, nested values as JSON text) so both engines'
results hash the same way. Every query runs over the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmodel import oracle as O
from clickmodel.operators import base as B
from clickmodel.operators import items as IT
from clickmodel.operators import params as PR
from clickmodel.operators import quality as Q
from clickmodel.operators import serving as SV
from clickmodel.operators import sessions as SS
from clickmodel.operators import staging as ST
from clickmodel.operators.users import USER_SNAPSHOT_FIELDS, user_snapshot
from clickmodel.plans import planner as PL
from clickmodel.plans.jobs import QUARANTINE, run_base, run_sessions
from clickmodel.session import shared_folder
from clickmodel.sources import testdata as TD
from clickmodel.sources.files import list_partition_dates, list_raw_dates, raw_days, read_days, read_partitioned
from clickmodel.sources.sinks import partition_rows, write_partitioned

ID = "event_bundle_sequence_id"
QUERY_EXCLUSIONS = ["gclid", "ref", "parameter"]
WINDOW_START, WINDOW_DAYS, EXACT_DAY = "2024-01-05", 7, "2024-01-10"


def _raw(spark, d):
    return TD.raw_events(spark, d)


def _flat(spark, d, raw_name_flags=False):
    src = B.select_source(_raw(spark, d), keep=[ID])
    return B.flatten_event(src, raw_name_flags=raw_name_flags, keep=[ID]).withColumnRenamed(ID, "event_id")


def _base(spark, d, by_day=False):
    return B.base_model(_raw(spark, d), keep=[ID], by_day=by_day).withColumnRenamed(ID, "event_id")


def _staged(spark, d, dedup=True, by_day=False):
    return ST.stage_events(_base(spark, d, by_day) if dedup else _flat(spark, d))


def _sessions(spark, d):
    return SS.session_start(SS.first_event_per_session(SS.drop_boundary_events(_staged(spark, d))))


def _ds(c: str) -> F.Column:
    return F.col(c).cast("string").alias(c)


def _items() -> F.Column:
    return F.to_json("items").alias("items_json")


REG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REG[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- params / items
@register("unnest_key", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, u.value.string_value AS page_title FROM raw "
    "LEFT JOIN LATERAL (SELECT unnest(list_filter(event_params, lambda x: x.key = 'page_title')) AS u) t ON true",
    upto="raw"))
def q_unnest_key(spark, d):
    return PR.unnest_key(_raw(spark, d), "event_params", "page_title").select(F.col(ID).alias("event_id"), "page_title")


@register("unnest_key_lower", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, lower(u.value.string_value) AS source FROM raw "
    "LEFT JOIN LATERAL (SELECT unnest(list_filter(event_params, lambda x: x.key = 'source')) AS u) t ON true",
    upto="raw"))
def q_unnest_key_lower(spark, d):
    return PR.unnest_key(_raw(spark, d), "event_params", "source", "lower_string_value") \
        .select(F.col(ID).alias("event_id"), "source")


@register("params_map", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, "
    "CAST(len(list_distinct(list_transform(event_params, lambda x: x.key))) AS BIGINT) AS n_params, "
    f"{O.pval('page_title')} AS page_title, {O.pval('ga_session_id', 'int_value')} AS ga_session_id FROM raw",
    upto="raw"))
def q_params_map(spark, d):
    m = PR.with_params_map(_raw(spark, d))
    return m.select(F.col(ID).alias("event_id"), F.size("params_map").cast("long").alias("n_params"),
                    F.col("params_map")["page_title"]["string_value"].alias("page_title"),
                    F.col("params_map")["ga_session_id"]["int_value"].alias("ga_session_id"))


EXTRACT_COLS = [c for c, *_ in PR.EXTRACTED_PARAMS] + ["session_engaged"]


@register("extract_params", O.with_layers(f"SELECT event_id, {', '.join(EXTRACT_COLS)} FROM flat", upto="flat"))
def q_extract_params(spark, d):
    return _flat(spark, d).select("event_id", *EXTRACT_COLS)


@register("session_engaged", O.with_layers("SELECT event_id, session_engaged FROM flat", upto="flat"))
def q_session_engaged(spark, d):
    return _flat(spark, d).select("event_id", "session_engaged")


@register("normalize_items", O.with_layers(
    f"SELECT event_id, CAST(len(items) AS BIGINT) AS n_items, {O.sjson('items')} AS items_json FROM flat",
    upto="flat"))
def q_normalize_items(spark, d):
    f = _flat(spark, d)
    return f.select("event_id", F.size("items").cast("long").alias("n_items"), F.to_json("items").alias("items_json"))


@register("explode_items", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, CAST(t.pos - 1 AS BIGINT) AS item_index, "
    "t.it.item_id AS item_id, t.it.quantity AS quantity, t.it.price AS price FROM raw "
    "LEFT JOIN LATERAL (SELECT unnest(items) AS it, generate_subscripts(items, 1) AS pos) t ON true",
    upto="raw"))
def q_explode_items(spark, d):
    x = IT.explode_items(_raw(spark, d).select(F.col(ID).alias("event_id"), "items"))
    return x.select("event_id", F.col("item_index").cast("long").alias("item_index"),
                    F.col("item.item_id").alias("item_id"), F.col("item.quantity").alias("quantity"),
                    F.col("item.price").alias("price"))


@register("collect_items", O.with_layers(
    f"SELECT event_bundle_sequence_id AS event_id, {O.sjson('coalesce(items, [])')} AS items_json "
    "FROM (SELECT DISTINCT event_bundle_sequence_id, items FROM raw) t", upto="raw"))
def q_collect_items(spark, d):
    x = IT.explode_items(_raw(spark, d).select(F.col(ID).alias("event_id"), "items").distinct())
    return IT.collect_items(x, ["event_id"]).select("event_id", F.to_json("items").alias("items_json"))


# ---------------------------------------------------------------- base
SOURCE_SCALARS = ["event_timestamp", "event_name", "user_id", "user_pseudo_id", "stream_id", "platform",
                  "event_previous_timestamp", "event_value_in_usd", "event_server_timestamp_offset",
                  "user_first_touch_timestamp", *B.ECOMMERCE_COLUMNS, "property_id"]


@register("select_source", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, CAST(try_strptime(event_date, '%Y%m%d')::DATE AS VARCHAR) "
    "AS event_date_dt, event_timestamp, event_name, user_id, user_pseudo_id, stream_id, platform, "
    "event_previous_timestamp, event_value_in_usd, event_server_timestamp_offset, user_first_touch_timestamp, "
    + ", ".join(f"ecommerce.{c} AS {c}" for c in B.ECOMMERCE_COLUMNS)
    + f", CAST(999999999 AS BIGINT) AS property_id, {O.sjson('items')} AS items_json FROM raw", upto="raw"))
def q_select_source(spark, d):
    s = B.select_source(_raw(spark, d), keep=[ID])
    return s.select(F.col(ID).alias("event_id"), _ds("event_date_dt"), *SOURCE_SCALARS, _items())


FLAT_SCALARS = [
    "event_timestamp", "event_name", "privacy_info_analytics_storage", "privacy_info_ads_storage",
    "privacy_info_uses_transient_token", "user_id", "user_pseudo_id", "user_first_touch_timestamp",
    "user_ltv_revenue", "user_ltv_currency",
    *[f"{s}_{f}" for s in ("device", "geo", "app_info") for f in B.FLAT_STRUCT_FIELDS[s]],
    "user_campaign", "user_medium", "user_source", "stream_id", "platform", *EXTRACT_COLS,
    "is_page_view", "is_purchase", "property_id", "event_id",
]


@register("flatten_event", O.with_layers(
    f"SELECT CAST(event_date_dt AS VARCHAR) AS event_date_dt, {', '.join(FLAT_SCALARS)}, {O.sjson('items')} AS items_json "
    "FROM flat", upto="flat"))
def q_flatten_event(spark, d):
    return _flat(spark, d).select(_ds("event_date_dt"), *FLAT_SCALARS, _items())


@register("ecommerce_repack", O.with_layers(
    f"SELECT event_id, {O.sjson('ecommerce')} AS ecommerce_json FROM flat", upto="flat"))
def q_ecommerce_repack(spark, d):
    s = B.ecommerce_repack(B.select_source(_raw(spark, d), keep=[ID]))
    return s.select(F.col(ID).alias("event_id"), F.to_json("ecommerce").alias("ecommerce_json"))


@register("clean_event_name", O.with_layers("SELECT event_id, event_name FROM flat", upto="flat"))
def q_clean_event_name(spark, d):
    return _flat(spark, d).select("event_id", "event_name")


@register("parse_event_date", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, event_date, "
    "CAST(try_strptime(event_date, '%Y%m%d')::DATE AS VARCHAR) AS event_date_dt, "
    "CAST(try_strptime(substr(event_date, 1, 6) || '45', '%Y%m%d')::DATE AS VARCHAR) AS bad_date_dt FROM raw",
    upto="raw"))
def q_parse_event_date(spark, d):
    from clickmodel.functions.dates import parse_yyyymmdd
    r = _raw(spark, d)
    return r.select(F.col(ID).alias("event_id"), "event_date",
                    parse_yyyymmdd("event_date").cast("string").alias("event_date_dt"),
                    parse_yyyymmdd(F.concat(F.substring("event_date", 1, 6), F.lit("45")))
                    .cast("string").alias("bad_date_dt"))


@register("event_flags", O.with_layers("SELECT event_id, is_page_view, is_purchase FROM flat", upto="flat"))
def q_event_flags(spark, d):
    return _flat(spark, d).select("event_id", "is_page_view", "is_purchase")


@register("event_flags_raw_name", O.with_layers(
    "SELECT event_id, is_page_view, is_purchase FROM flat", upto="flat", flags="raw"))
def q_event_flags_raw(spark, d):
    return _flat(spark, d, raw_name_flags=True).select("event_id", "is_page_view", "is_purchase")


DEDUP_OUT = ["event_id", "stream_id", "user_pseudo_id", "session_id", "event_name", "event_timestamp"]


@register("dedup_events", O.with_layers(
    f"SELECT CAST(event_date_dt AS VARCHAR) AS event_date_dt, {', '.join(DEDUP_OUT)}, {O.sjson('items')} AS items_json "
    "FROM base", upto="base"))
def q_dedup_events(spark, d):
    return _base(spark, d).select(_ds("event_date_dt"), *DEDUP_OUT, _items())


@register("union_days", O.with_layers(
    "SELECT event_bundle_sequence_id AS event_id, event_date, "
    "CASE WHEN CAST(substr(event_date, 7, 2) AS INTEGER) % 2 = 0 THEN platform END AS platform FROM raw",
    upto="raw"))
def q_union_days(spark, d):
    from clickmodel.sources.files import union_days
    r = _raw(spark, d).select(F.col(ID).alias("event_id"), "event_date", "platform")
    even = F.substring("event_date", 7, 2).cast("int") % 2 == 0
    # the odd days arrive from an export that lacks the platform column
    return union_days([r.where(even), r.where(~even).drop("platform")])


# ---------------------------------------------------------------- keys / urls
for _k in ["client_key", "session_key", "session_partition_key", "event_key", "page_key", "page_engagement_key"]:
    register(_k, O.with_layers(f"SELECT event_id, {_k} FROM stg"))(
        (lambda k: lambda spark, d: _staged(spark, d).select("event_id", k))(_k))


@register("gclid_attribution", O.with_layers(
    "SELECT event_id, event_source, event_medium, event_campaign FROM stg"))
def q_gclid(spark, d):
    return _staged(spark, d).select("event_id", "event_source", "event_medium", "event_campaign")


@register("strip_query", f"SELECT page_id, {O.strip_query('url')} AS url FROM pages")
def q_strip_query(spark, d):
    from clickmodel.functions.urls import strip_query
    return TD.table(spark, d, "pages").select("page_id", strip_query("url").alias("url"))


@register("encode_url", f"SELECT page_id, {O.url_encode('url')} AS url_encoded FROM pages")
def q_encode_url(spark, d):
    from clickmodel.functions.urls import encode_url
    return TD.table(spark, d, "pages").select("page_id", encode_url("url").alias("url_encoded"))


@register("url_originals", O.with_layers("SELECT event_id, original_page_location, original_page_referrer FROM stg"))
def q_url_originals(spark, d):
    return _staged(spark, d).select("event_id", "original_page_location", "original_page_referrer")


@register("url_parts", O.with_layers("SELECT event_id, page_path, page_hostname, page_query_string FROM stg"))
def q_url_parts(spark, d):
    return _staged(spark, d).select("event_id", "page_path", "page_hostname", "page_query_string")


@register("url_parts_encoded", O.with_layers(
    f"SELECT event_id, {O.url_encode('page_location')} AS page_path, CAST(NULL AS VARCHAR) AS page_hostname, "
    "CAST(NULL AS VARCHAR) AS page_query_string FROM base", upto="base"))
def q_url_parts_encoded(spark, d):
    # the original job parsed the percent-encoded copy: the whole encoded text is the path
    b = ST.url_parts(_base(spark, d), url_mode="encoded")
    return b.select("event_id", "page_path", "page_hostname", "page_query_string")


def _params_removed_sql(u: str) -> str:
    """Without regular expressions: split at the first '?', drop the named parts, join again."""
    named = " OR ".join(f"starts_with(p, '{n}=')" for n in QUERY_EXCLUSIONS)
    left = f"list_filter(string_split(substr({u}, strpos({u}, '?') + 1), '&'), lambda p: NOT ({named}))"
    return (f"CASE WHEN strpos({u}, '?') = 0 THEN {u} ELSE split_part({u}, '?', 1) || "
            f"CASE WHEN len({left}) > 0 THEN '?' || array_to_string({left}, '&') ELSE '' END END")


@register("query_param_removal", O.with_layers(
    f"SELECT event_id, {_params_removed_sql('page_location')} AS page_location, "
    f"{_params_removed_sql('page_referrer')} AS page_referrer FROM base", upto="base"))
def q_query_param_removal(spark, d):
    b = ST.query_param_removal(_base(spark, d), QUERY_EXCLUSIONS)
    return b.select("event_id", "page_location", "page_referrer")


# ---------------------------------------------------------------- sessions
@register("date_window", O.with_layers(
    "SELECT event_id, CAST(event_date_dt AS VARCHAR) AS event_date_dt FROM stg "
    f"WHERE event_date_dt BETWEEN DATE '{WINDOW_START}' AND DATE '{WINDOW_START}' + INTERVAL {WINDOW_DAYS - 1} DAY"))
def q_date_window(spark, d):
    return SS.date_window(_staged(spark, d), WINDOW_START, WINDOW_DAYS).select("event_id", _ds("event_date_dt"))


BACK_START = "2024-01-20"


@register("date_window_back", O.with_layers(
    "SELECT event_id, CAST(event_date_dt AS VARCHAR) AS event_date_dt FROM stg "
    f"WHERE event_date_dt BETWEEN DATE '{BACK_START}' - INTERVAL {WINDOW_DAYS - 1} DAY AND DATE '{BACK_START}'"))
def q_date_window_back(spark, d):
    # ``days`` counting back from ``start`` (inclusive), as the base job plans days
    return SS.date_window(_staged(spark, d), BACK_START, WINDOW_DAYS, direction="back") \
        .select("event_id", _ds("event_date_dt"))


@register("date_window_exact", O.with_layers(
    f"SELECT event_id, CAST(event_date_dt AS VARCHAR) AS event_date_dt FROM stg WHERE event_date_dt = DATE '{EXACT_DAY}'"))
def q_date_window_exact(spark, d):
    return SS.date_window_exact(_staged(spark, d), EXACT_DAY).select("event_id", _ds("event_date_dt"))


@register("drop_boundary_events", O.with_layers(
    "SELECT event_id, event_name FROM stg WHERE event_name NOT IN ('first_visit', 'session_start')"))
def q_drop_boundary(spark, d):
    return SS.drop_boundary_events(_staged(spark, d)).select("event_id", "event_name")


@register("first_event_per_session", O.with_layers(
    "SELECT session_key, event_id, event_timestamp FROM first_ev", upto="sess"))
def q_first_event(spark, d):
    f = SS.first_event_per_session(SS.drop_boundary_events(_staged(spark, d)))
    return f.select("session_key", "event_id", "event_timestamp")


SESSION_COLS = [
    "session_key", "session_start_timestamp", "landing_page_path", "landing_page", "landing_page_hostname",
    "landing_page_referrer", "geo_continent", "geo_country", "geo_region", "geo_city", "geo_sub_continent",
    "geo_metro", "stream_id", "platform", "device_category", "device_mobile_brand_name",
    "device_mobile_model_name", "device_mobile_marketing_name", "device_mobile_os_hardware_model",
    "device_operating_system", "device_operating_system_version", "device_vendor_id", "device_advertising_id",
    "device_language", "device_is_limited_ad_tracking", "device_time_zone_offset_seconds", "device_browser",
    "device_web_info_browser", "device_web_info_browser_version", "device_web_info_hostname", "session_number",
    "is_first_session", "user_campaign", "user_medium", "user_source",
]


@register("session_start", O.with_layers(
    f"SELECT CAST(session_start_date AS VARCHAR) AS session_start_date, {', '.join(SESSION_COLS)} FROM sess",
    upto="sess"))
def q_session_start(spark, d):
    return _sessions(spark, d).select(_ds("session_start_date"), *SESSION_COLS)


@register("is_first_session", O.with_layers(
    "SELECT session_key, session_number, is_first_session FROM sess", upto="sess"))
def q_is_first_session(spark, d):
    return _sessions(spark, d).select("session_key", "session_number", "is_first_session")


TRAFFIC_COLS = ["session_source", "session_medium", "session_campaign"]


@register("session_traffic", O.with_layers(
    f"SELECT s.session_key, s.landing_page, {', '.join('t.' + c for c in TRAFFIC_COLS)} "
    "FROM sess s LEFT JOIN traffic t ON s.session_key = t.session_key", upto="sess"))
def q_session_traffic(spark, d):
    j = SS.session_traffic(_sessions(spark, d), TD.traffic_sources(spark, d))
    return j.select("session_key", "landing_page", *TRAFFIC_COLS)


@register("session_derived", O.with_layers(
    "SELECT s.session_key, s.session_number, x.session_event_count, x.session_last_event_type "
    "FROM sess s LEFT JOIN derived x ON s.session_key = x.session_key", upto="sess"))
def q_session_derived(spark, d):
    j = SS.session_derived(_sessions(spark, d), TD.derived_session_properties(spark, d), join_derived=True)
    return j.select("session_key", "session_number", "session_event_count", "session_last_event_type")


@register("sessions_dim", O.with_layers(
    f"SELECT CAST(s.session_start_date AS VARCHAR) AS session_start_date, "
    f"{', '.join('s.' + c for c in SESSION_COLS)}, {', '.join('t.' + c for c in TRAFFIC_COLS)}, "
    "x.session_event_count, x.session_last_event_type FROM sess s "
    "LEFT JOIN traffic t ON s.session_key = t.session_key LEFT JOIN derived x ON s.session_key = x.session_key",
    upto="sess"))
def q_sessions_dim(spark, d):
    """Flagship: raw -> base -> staged -> session dimension with both joins."""
    s = SS.build_sessions(_staged(spark, d), traffic=TD.traffic_sources(spark, d),
                          derived=TD.derived_session_properties(spark, d), join_derived=True)
    return s.select(_ds("session_start_date"), *SESSION_COLS, *TRAFFIC_COLS,
                    "session_event_count", "session_last_event_type")


# ---------------------------------------------------------------- serving / quality / users
def _serving_sql_cols() -> str:
    out = []
    for name, typ in SV.SERVING_COLUMNS:
        if name == "_event_date_dt":
            out.append("CAST(event_date_dt AS VARCHAR) AS _event_date_dt")
        elif typ == "json":
            out.append(f"CAST(to_json({name}) AS VARCHAR) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


@register("serving_projection", O.with_layers(f"SELECT {_serving_sql_cols()} FROM stg"))
def q_serving_projection(spark, d):
    s = SV.serving_projection(_staged(spark, d))
    return s.withColumn("_event_date_dt", F.col("_event_date_dt").cast("string"))


@register("served_count", O.with_layers("SELECT count(*) AS row_count FROM stg"))
def q_served_count(spark, d):
    return Q.served_count(SV.serving_projection(_staged(spark, d)))


@register("unique_violations", O.with_layers(
    "SELECT event_key, count(*) AS n_rows FROM stg GROUP BY event_key HAVING count(*) > 1", dedup=False))
def q_unique_violations(spark, d):
    # the declared uniqueness test, run on staged rows built without the dedup step
    return Q.unique_violations(_staged(spark, d, dedup=False))


USER_COLS = [a for _, _, a in USER_SNAPSHOT_FIELDS]


def _user_raw_sql() -> str:
    k = "c_custkey"
    pr = ", ".join(f"'{n}': CAST({k} % {m} AS DOUBLE) / CAST({m} AS DOUBLE)" for n, m in
                   (("in_app_purchase_score_7d", 100), ("purchase_score_7d", 50), ("churn_score_7d", 20),
                    ("revenue_28d_in_usd", 8)))
    return f"""WITH ur AS (SELECT
  {{'last_active_timestamp_micros': 1704067200000000 + {k} * 1000,
    'user_first_touch_timestamp_micros': 1704067200000000 - {k} * 1000000,
    'first_purchase_date': CASE WHEN {k} % 3 <> 0 THEN '2024-01-' || lpad(CAST({k} % 28 + 1 AS VARCHAR), 2, '0') END}}
    AS user_info,
  {{'operating_system': {O.case(f'{k} % 3', {0: 'Windows', 1: 'iOS', 2: 'Android'})}, 'category': lower(c_mktsegment),
    'mobile_brand_name': {O.case(f'{k} % 3', {1: 'Apple', 2: 'Google'})},
    'mobile_model_name': {O.case(f'{k} % 3', {1: 'iPhone', 2: 'Pixel'})},
    'unified_screen_name': 'screen_' || CAST({k} % 5 AS VARCHAR)}} AS device,
  {{'city': 'City ' || CAST({k} % 50 AS VARCHAR), 'country': n_name,
    'continent': {O.case('n_regionkey', {0: 'Africa', 1: 'Americas', 2: 'Asia', 3: 'Europe', 4: 'Middle East'})},
    'region': CAST(n_regionkey AS VARCHAR)}} AS geo,
  {{'revenue_in_usd': c_acctbal, 'sessions': {k} % 20, 'engagement_time_millis': {k} * 1000,
    'purchases': {k} % 5, 'engaged_sessions': {k} % 10, 'session_duration_micros': {k} * 1000000}} AS user_ltv,
  {{{pr}}} AS predictions,
  {{'is_limited_ad_tracking': CASE WHEN {k} % 2 = 0 THEN 'No' ELSE 'Yes' END,
    'is_ads_personalization_allowed': CASE WHEN {k} % 3 <> 0 THEN 'Yes' END}} AS privacy_info,
  CASE WHEN {k} % 97 = 0 THEN '2024-13-45' ELSE strftime(DATE '2024-01-01' + CAST({k} % 30 AS INTEGER), '%Y%m%d') END
    AS occurrence_date,
  '20240131' AS last_updated_date,
  [{O.param('segment', s='c_mktsegment')}] AS user_properties,
  [{{'id': CAST(c_nationkey AS BIGINT), 'name': n_name}}] AS audiences
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
"""


@register("user_snapshot", _user_raw_sql() + "SELECT "
          + ", ".join(f"{s}.{f} AS {a}" for s, f, a in USER_SNAPSHOT_FIELDS)
          + ", CAST(try_strptime(occurrence_date, '%Y%m%d')::DATE AS VARCHAR) AS occurrence_date"
          + ", CAST(try_strptime(last_updated_date, '%Y%m%d')::DATE AS VARCHAR) AS last_updated_date"
          + f", {O.sjson('user_properties')} AS user_properties, {O.sjson('audiences')} AS audiences FROM ur")
def q_user_snapshot(spark, d):
    u = user_snapshot(TD.user_snapshot_raw(spark, d))
    return u.select(*USER_COLS, _ds("occurrence_date"), _ds("last_updated_date"),
                    F.to_json("user_properties").alias("user_properties"), F.to_json("audiences").alias("audiences"))


def _type_sql(c: str) -> str:
    """Spark's name for the type of a DuckDB column."""
    t = f"typeof(any_value({c}))"
    names = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date"}
    return f"CASE {' '.join(f"WHEN {t} = '{k}' THEN '{v}'" for k, v in names.items())} WHEN suffix({t}, '[]') THEN 'array' ELSE 'struct' END"


# The staging columns in their order, after the day and the base event's own columns.
STAGING_ORDER = ["client_key", "session_key", "session_partition_key", "event_key", "original_page_location", "original_page_referrer",
                 "page_path", "page_hostname", "page_query_string", "page_key", "page_engagement_key"]
STAGED_ORDER = ["event_date_dt", *[n for n, _ in SV.SERVING_COLUMNS if n not in ("_event_date_dt", *STAGING_ORDER)], *STAGING_ORDER]


@register("staged_columns", O.with_layers(" UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS name, {_type_sql(c)} AS type, count({c}) AS n_values FROM stg"
    for i, c in enumerate(STAGED_ORDER, 1))))
def q_staged_columns(spark, d):
    # the staged frame's columns as rows: place, name, type and number of values, in one aggregation
    staged = ST.stage_events(B.base_model(_raw(spark, d)))
    counts = staged.agg(*[F.count(c).alias(c) for c in staged.columns])
    kinds = dict(staged.dtypes)
    rows = [F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("name"),
                     F.lit(kinds[c].partition("<")[0]).alias("type"), F.col(c).alias("n_values")) for i, c in enumerate(staged.columns, 1)]
    return counts.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- planning
# The raw landing zone holds one export per event day; days up to the 10th count as
# already processed, and the newest day is "today" (still being written).
RAW_DATES_SQL = "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events"
PROCESSED_SQL = f"SELECT d FROM ({RAW_DATES_SQL}) r WHERE day(d) <= 10"


def _dates(spark, d):
    raw = TD.table(spark, d, "events").select(F.col("ts").cast("date").alias("date")).distinct()
    return raw, raw.where(F.dayofmonth("date") <= 10)


@register("plan_dates", f"""WITH r AS ({RAW_DATES_SQL}), p AS ({PROCESSED_SQL})
SELECT CAST(d AS VARCHAR) AS date, 'process' AS status FROM (SELECT d FROM r EXCEPT SELECT d FROM p) x
UNION ALL SELECT CAST(d AS VARCHAR), 'skip' FROM (SELECT d FROM p INTERSECT SELECT d FROM r) y""")
def q_plan_dates(spark, d):
    raw, processed = _dates(spark, d)
    return PL.plan_dates(raw, processed).select(_ds("date"), "status")


@register("plan_dates_window", f"""WITH r AS ({RAW_DATES_SQL}), p AS ({PROCESSED_SQL}),
s AS (SELECT max(d) AS start FROM r),
c AS (SELECT CAST(start - INTERVAL (i) DAY AS DATE) AS d FROM s, range(14) t(i))
SELECT CAST(d AS VARCHAR) AS date, CASE WHEN d IN (SELECT d FROM r) THEN 'process' ELSE 'missing' END AS status
FROM (SELECT d FROM c EXCEPT SELECT d FROM p) x
UNION ALL SELECT CAST(d AS VARCHAR), 'skip' FROM (SELECT d FROM p INTERSECT SELECT d FROM r) y""")
def q_plan_dates_window(spark, d):
    raw, processed = _dates(spark, d)
    start = raw.select(F.max("date"))
    return PL.plan_dates(raw, processed, start=start, days=14).select(_ds("date"), "status")


@register("plan_files", f"""WITH r AS ({RAW_DATES_SQL}), p AS ({PROCESSED_SQL}),
f AS (SELECT 'events_' || strftime(d, '%Y%m%d') || '.parquet' AS file_name, d FROM r),
l AS (SELECT 'events_' || strftime(d, '%Y%m%d') || '.parquet' AS file_name FROM p)
SELECT file_name FROM f WHERE d < (SELECT max(d) FROM r) AND file_name NOT IN (SELECT file_name FROM l)""")
def q_plan_files(spark, d):
    raw, processed = _dates(spark, d)
    name = F.concat(F.lit("events_"), F.date_format("date", "yyyyMMdd"), F.lit(".parquet")).alias("file_name")
    as_of = raw.select(F.max("date"))
    return PL.plan_files(raw.select(name, "date"), processed.select(name), as_of=as_of)


# ---------------------------------------------------------------- jobs over files
def _root(spark) -> str:
    return f"{shared_folder(spark)}/jobs-{uuid.uuid4().hex}"


BASE_BY_DAY = "SELECT CAST(event_date_dt AS VARCHAR) AS event_date_dt, count(*) AS n_rows FROM base GROUP BY 1"


@register("partitions_written", O.with_layers(BASE_BY_DAY, upto="base"))
def q_partitions_written(spark, d):
    # the report of what was written: days observed by the write, rows from the files' footers
    out = _root(spark)
    days = write_partitioned(_base(spark, d), out, "event_date_dt")
    return partition_rows(spark, out, "event_date_dt", days).select(F.col("date").cast("string").alias("event_date_dt"), "n_rows")


@register("list_raw_dates", f"SELECT CAST(d AS VARCHAR) AS date, 'events_' || strftime(d, '%Y%m%d') || '.parquet' AS file_name FROM ({RAW_DATES_SQL}) r")
def q_list_raw_dates(spark, d):
    # beside the exports: an archive one level down, malformed names and an impossible date
    root = _root(spark)
    raw = _raw(spark, d)
    TD.land_exports(spark, raw, root)
    TD.land_exports(spark, raw.withColumn("old", F.lit("20231231")), f"{root}/archive", day="old")
    TD.land_exports(spark, raw.withColumn("odd", F.concat(F.substring("event_date", 1, 6), F.lit("45"))), root, day="odd")
    return list_raw_dates(spark, root).select(_ds("date"), "file_name")


@register("list_processed_dates", f"SELECT CAST(d AS VARCHAR) AS date FROM ({RAW_DATES_SQL}) r")
def q_list_processed_dates(spark, d):
    # rows without a date make a NULL partition, which is no processed day
    out = _root(spark)
    base = _base(spark, d)
    nameless = base.withColumn("event_date_dt", F.lit(None).cast("date"))
    base.unionByName(nameless).write.partitionBy("event_date_dt").parquet(out)
    return list_partition_dates(spark, out).select(_ds("date"))


@register("read_partitioned", O.with_layers(
    "SELECT event_id, CAST(event_date_dt AS VARCHAR) AS event_date_dt, CAST(event_date_dt AS VARCHAR) AS _event_date_dt, "
    "session_key FROM stg"))
def q_read_partitioned(spark, d):
    out = _root(spark)
    write_partitioned(_staged(spark, d, by_day=True), out, "event_date_dt", keep_copy="_event_date_dt", dealt=True)
    return read_partitioned(spark, out).select("event_id", _ds("event_date_dt"), _ds("_event_date_dt"), "session_key")


_DAY = "CAST(substr(event_date, 7, 2) AS INTEGER)"


@register("read_days", O.with_layers(
    f"SELECT event_bundle_sequence_id AS event_id, event_date, CASE WHEN {_DAY} % 3 = 1 "
    "THEN CASE WHEN privacy_info.analytics_storage = 1 THEN 'Yes' ELSE 'No' END "
    "ELSE CAST(privacy_info.analytics_storage AS VARCHAR) END AS analytics_storage, "
    "CAST(len(event_params) + 1 AS BIGINT) AS n_params, event_bundle_sequence_id * 0.5::DOUBLE AS score, "
    f"CASE WHEN {_DAY} % 3 = 2 THEN NULL ELSE stream_id END AS stream_id, "
    "CAST(to_json(list_transform(items, lambda x: CASE WHEN x IS NULL THEN NULL ELSE {'item_id': x.item_id, 'quantity': x.quantity, "
    "'price': x.price, 'item_name': 'item ' || x.item_id} END)) AS VARCHAR) AS items_json FROM raw", upto="raw"))
def q_read_days(spark, d):
    # exports with a double-valued parameter and an item field that the model does not name;
    # privacy flags as INT32, INT64 or text, and a day's stream id as text that is no number
    root, raw, day = _root(spark), _raw(spark, d), F.substring("event_date", 7, 2).cast("int") % 3
    value = lambda s, i, f: F.struct(s.alias("string_value"), i.alias("int_value"), f.alias("double_value"))
    none, eid = F.lit(None), F.col(ID)
    score = F.struct(F.lit("score").alias("key"), value(none.cast("string"), none.cast("bigint"), eid * F.lit(0.5)).alias("value"))
    raw = raw.withColumns({
        "event_params": F.array_append(F.transform("event_params", lambda p: F.struct(
            p["key"].alias("key"), value(p["value"]["string_value"], p["value"]["int_value"], none.cast("double")).alias("value"))), score),
        "items": F.transform("items", lambda x: F.when(x.isNotNull(), x.withField("item_name", F.concat(F.lit("item "), x["item_id"])))),
    })
    flag = F.col("privacy_info.analytics_storage")
    as_text = F.when(flag == 1, F.lit("Yes")).otherwise(F.lit("No"))
    TD.land_exports(spark, raw.where(day == 0).withColumn("privacy_info", F.col("privacy_info").withField("analytics_storage", flag.cast("bigint"))), root)
    TD.land_exports(spark, raw.where(day == 1).withColumn("privacy_info", F.col("privacy_info").withField("analytics_storage", as_text)), root)
    TD.land_exports(spark, raw.where(day == 2).withColumn("stream_id", F.lit("n/a")), root)
    got = read_days(spark, root, raw_days(spark, root))
    found = F.filter("event_params", lambda p: p["key"] == "score")
    return got.select(eid.alias("event_id"), "event_date", flag.alias("analytics_storage"), F.size("event_params").cast("long").alias("n_params"),
                      F.get(found, 0)["value"]["double_value"].alias("score"), "stream_id",
                      F.to_json("items", {"ignoreNullFields": "false"}).alias("items_json"))


def wrapped_sum(c: str) -> F.Column:
    """The sum of whole numbers as a check of rows: added up exactly, then folded into a bigint
    modulo 2**64. Where the sum fits a bigint it is the sum itself; a day of some 5,400 events has
    timestamps (microseconds) whose sum does not, and there a lost or doubled row still changes it."""
    low, span = (F.lit(str(n)).cast("decimal(20,0)") for n in (2**63, 2**64))
    return (F.pmod(F.sum(F.col(c).cast("decimal(20,0)")) + low, span) - low).cast("bigint")


@register("overwrite_days", O.with_layers(
    "SELECT CAST(event_date_dt AS VARCHAR) AS event_date_dt, count(*) AS n_rows, CAST(sum(event_timestamp) AS BIGINT) AS timestamps "
    "FROM base GROUP BY 1", upto="base"))
def q_overwrite_days(spark, d):
    # every 17th event arrives a day late, in the next day's export; the exports are processed in
    # two runs, and a third finds nothing to do
    root, out = f"{_root(spark)}/raw", f"{_root(spark)}/base"
    day = F.to_date("event_date", "yyyyMMdd")
    raw = _raw(spark, d).withColumn("export", F.date_format(F.date_add(day, (F.col(ID) % 17 == 0).cast("int")), "yyyyMMdd"))
    for part in (F.dayofmonth(F.to_date("export", "yyyyMMdd")) <= 10, F.dayofmonth(F.to_date("export", "yyyyMMdd")) > 10):
        TD.land_exports(spark, raw.where(part).select("*"), root, day="export")
        run_base(spark, root, out)
    run_base(spark, root, out)
    base = read_partitioned(spark, out)
    return base.groupBy(_ds("event_date_dt")).agg(F.count("*").alias("n_rows"), wrapped_sum("event_timestamp").alias("timestamps"))


@register("quarantine_days", O.with_layers(
    "SELECT CAST(date AS VARCHAR) AS date, status, written, coalesce(n_rows, 0) AS n_rows, coalesce(n_bad, 0) AS n_quarantined, "
    "coalesce(n_bad, 0) AS n_stored FROM "
    "(SELECT DISTINCT try_strptime(event_date, '%Y%m%d')::DATE AS date, 'process' AS status, true AS written FROM raw) r "
    "LEFT JOIN (SELECT event_date_dt AS date, count(*) AS n_rows FROM base WHERE event_id % 19 <> 0 GROUP BY 1) b USING (date) "
    "LEFT JOIN (SELECT try_strptime(event_date, '%Y%m%d')::DATE AS date, count(*) AS n_bad FROM raw "
    "WHERE event_bundle_sequence_id % 19 = 0 GROUP BY 1) q USING (date)", upto="base"))
def q_quarantine_days(spark, d):
    # every 19th event's date is malformed; the report and the rows set aside, after two runs
    root, out = f"{_root(spark)}/raw", f"{_root(spark)}/base"
    dashed = F.concat_ws("-", F.substring("event_date", 1, 4), F.substring("event_date", 5, 2), F.substring("event_date", 7, 2))
    raw = _raw(spark, d).withColumn("export", F.col("event_date")).withColumn("event_date", F.when(F.col(ID) % 19 == 0, dashed).otherwise(F.col("event_date")))
    TD.land_exports(spark, raw, root, day="export")
    report = run_base(spark, root, out)
    run_base(spark, root, out)
    aside = spark.read.parquet(f"{out}/{QUARANTINE}").groupBy(F.col("export_date").alias("date")).agg(F.count("*").alias("n_stored"))
    joined = report.join(aside, "date", "left")
    return joined.select(_ds("date"), "status", "written", "n_rows", "n_quarantined", F.coalesce("n_stored", F.lit(0)).alias("n_stored"))


@register("sessions_over_days", O.with_layers(
    "SELECT client_key AS session_key, CAST(event_date_dt AS VARCHAR) AS session_start_date, event_timestamp AS session_start_timestamp, "
    "page_location AS landing_page FROM (SELECT *, row_number() OVER (PARTITION BY client_key ORDER BY "
    "CASE WHEN day(event_date_dt) <= 10 THEN 1 WHEN day(event_date_dt) <= 20 THEN 2 ELSE 3 END, event_timestamp NULLS FIRST, event_key) AS place "
    "FROM stg WHERE event_name NOT IN ('first_visit', 'session_start')) t WHERE place = 1"))
def q_sessions_over_days(spark, d):
    # a client's events as one session over many days; three windows, the second processed first
    root = _root(spark)
    staged = _staged(spark, d, by_day=True).withColumn("session_key", F.col("client_key"))
    write_partitioned(staged, f"{root}/stg", "event_date_dt", dealt=True)
    for start, days in (("2024-01-11", 10), ("2024-01-01", 10), ("2024-01-21", 11)):
        run_sessions(spark, f"{root}/stg", None, f"{root}/ses", start=start, days=days, look_back=31)
    ses = read_partitioned(spark, f"{root}/ses", column="session_start_date")
    return ses.select("session_key", _ds("session_start_date"), "session_start_timestamp", "landing_page")


@register("serving_coercion", O.with_layers(
    "SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN 12 WHEN 1 THEN 7 WHEN 4 THEN -3 END AS BIGINT) AS device_vendor_id, "
    "stream_id, CASE WHEN event_id % 2 = 0 THEN session_id END AS session_id, engagement_time_msec, "
    "CASE WHEN privacy_info_analytics_storage = 1 THEN 'Yes' ELSE 'No' END AS privacy_info_analytics_storage FROM stg"))
def q_serving_coercion(spark, d):
    # whole numbers as text, double, decimal and float; text flags are no numbers to coerce
    eid = F.col("event_id")
    texts = F.get(F.array(*map(F.lit, ["12.0", "7", "7.5", "abc", "-3.000"])), (eid % 5).cast("int"))
    staged = _staged(spark, d).withColumns({
        "device_vendor_id": texts, "stream_id": F.col("stream_id").cast("double"),
        "session_id": (F.col("session_id") + F.when(eid % 2 == 0, F.lit(0)).otherwise(F.lit(0.25))).cast("decimal(22,2)"),
        "engagement_time_msec": F.col("engagement_time_msec").cast("float"),
        "privacy_info_analytics_storage": F.when(F.col("privacy_info_analytics_storage") == 1, F.lit("Yes")).otherwise(F.lit("No"))})
    served = SV.serving_projection(staged.withColumn("user_id", eid.cast("string")))
    return served.select(F.col("user_id").cast("bigint").alias("event_id"), "device_vendor_id", "stream_id", "session_id",
                         "engagement_time_msec", "privacy_info_analytics_storage")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REG.items() if v[1] is not None}
