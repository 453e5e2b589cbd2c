"""Independent DuckDB SQL for the correctness gate.

The same fixture rules as ``clickmodel.sources.testdata`` and the same model semantics as the
operators, written as plain SQL over the driver's pre-registered views. Spark's ``to_json``
omits NULL struct fields while DuckDB writes ``null``; ``sjson`` strips them so JSON text
(and keys hashed from it) compare byte for byte.
"""

from __future__ import annotations


def sjson(expr: str) -> str:
    j = f"to_json({expr})"
    j = f"""regexp_replace({j}, '"[A-Za-z_]+":null,', '', 'g')"""
    j = f"""regexp_replace({j}, ',"[A-Za-z_]+":null', '', 'g')"""
    return f"""CAST(regexp_replace({j}, '"[A-Za-z_]+":null', '', 'g') AS VARCHAR)"""


def hkey(*parts: str) -> str:
    return f"base64(unhex(md5(concat_ws('', {', '.join(parts)}))))"


def param(key: str, s: str = "NULL", i: str = "NULL", present: str | None = None) -> str:
    k = f"'{key}'" if present is None else f"CASE WHEN {present} THEN '{key}' END"
    return f"{{'key': {k}, 'value': {{'string_value': CAST({s} AS VARCHAR), 'int_value': CAST({i} AS BIGINT)}}}}"


def pval(key: str, field: str = "string_value", arr: str = "event_params") -> str:
    return f"list_filter({arr}, lambda x: x.key = '{key}')[1].value.{field}"


def case(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {expr} = {k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} END"


ITEM_T = "STRUCT(item_id VARCHAR, quantity BIGINT, price DOUBLE)"
NULL_S, NULL_L, NULL_D = "CAST(NULL AS VARCHAR)", "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
DAY = "(CAST(ts AS DATE) - DATE '1970-01-01')"


def _raw_ctes() -> str:
    e, u = "event_id", "user_id"
    params = ", ".join([
        param("page_location", s="loc", present=f"{e} % 40 <> 39"),
        param("ga_session_id", i="day"),
        param("ga_session_number", i="session_number"),
        param("engagement_time_msec", i=f"({e} * 37) % 10000", present=f"{e} % 6 <> 5"),
        param("page_title", s="'Page ' || CAST(page_id AS VARCHAR)"),
        param("page_referrer", s="ref", present=f"{e} % 3 <> 0"),
        param("source", s=case(f"{e} % 5", {0: "Google", 1: "bing", 2: "(Direct)"}), present=f"{e} % 5 <> 4"),
        param("medium", s=case(f"{e} % 4", {0: "Organic", 1: "CPC", 2: "referral"}), present=f"{e} % 4 <> 3"),
        param("campaign", s=case(f"{e} % 6", {0: "(organic)", 1: "Spring_Sale", 2: "organic", 3: "(ORGANIC)"}),
              present=f"{e} % 6 <> 5"),
        param("content", s="'Banner_A'", present=f"{e} % 7 = 1"),
        param("term", s="'Running Shoes'", present=f"{e} % 9 = 2"),
        param("session_engaged", s=case(f"{e} % 4", {1: "1", 2: "0"}), i=f"CASE WHEN {e} % 4 = 0 THEN 1 END",
              present=f"{e} % 4 <> 3"),
        param("page_title", s="'Duplicate title'", present=f"{e} % 13 = 0"),
    ])
    return f"""
npg AS (SELECT count(*) AS n FROM pages),
ud AS (SELECT user_id, day, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS session_number
       FROM (SELECT DISTINCT user_id, {DAY} AS day FROM events) t),
itm AS (SELECT l_orderkey AS event_id,
               list({{'item_id': CAST(l_partkey AS VARCHAR), 'quantity': CAST(l_quantity AS BIGINT),
                      'price': l_extendedprice}}
                    ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR), CAST(l_quantity AS BIGINT), l_extendedprice)
               AS li_items
        FROM lineitem GROUP BY l_orderkey),
e0 AS (SELECT event_id, ts, user_id, event_type, value, {DAY} AS day,
              event_id % (SELECT n FROM npg) AS page_id FROM events),
e1 AS (SELECT e0.*, p.url, ud.session_number, itm.li_items
       FROM e0 LEFT JOIN pages p ON p.page_id = e0.page_id
       LEFT JOIN ud ON ud.user_id = e0.user_id AND ud.day = e0.day
       LEFT JOIN itm ON itm.event_id = e0.event_id),
e2 AS (SELECT *, CASE WHEN {e} % 50 = 25 THEN url || '/my page' ELSE url END AS url1 FROM e1),
e3 AS (SELECT *,
         CASE WHEN {e} % 7 = 0 THEN url1 || (CASE WHEN strpos(url1, '?') > 0 THEN '&' ELSE '?' END)
              || 'gclid=' || CAST({e} AS VARCHAR) ELSE url1 END AS loc,
         'https://ref.example.com/p' || CAST({e} % 17 AS VARCHAR)
              || CASE WHEN {e} % 5 = 0 THEN '?utm_source=news&parameter=x' ELSE '' END AS ref
       FROM e2),
raw1 AS (SELECT
  strftime(ts, '%Y%m%d') AS event_date,
  epoch_us(ts) AS event_timestamp,
  CASE WHEN event_type = 'view' THEN (CASE WHEN {e} % 2 = 0 THEN ' Page View ' ELSE 'page_view' END)
       WHEN event_type = 'signup' THEN 'first_visit' WHEN event_type = 'error' THEN 'session_start'
       ELSE event_type END AS event_name,
  list_filter([{params}], lambda x: x.key IS NOT NULL) AS event_params,
  {NULL_L} AS event_previous_timestamp,
  CASE WHEN event_type = 'purchase' THEN value END AS event_value_in_usd,
  {e} AS event_bundle_sequence_id,
  {e} % 1000 AS event_server_timestamp_offset,
  CASE WHEN {u} % 5 = 0 THEN 'u' || CAST({u} AS VARCHAR) END AS user_id,
  CAST({u} AS VARCHAR) || '.1704067200' AS user_pseudo_id,
  {{'analytics_storage': CAST({u} % 2 AS INTEGER), 'ads_storage': CASE WHEN {u} % 5 <> 0 THEN 1 END,
    'uses_transient_token': 'No'}} AS privacy_info,
  [{param("plan", s=f"CASE WHEN {u} % 2 = 0 THEN 'free' ELSE 'pro' END")}] AS user_properties,
  1704067200000000 - {u} * 1000000 AS user_first_touch_timestamp,
  {{'revenue': CAST({u} AS DOUBLE) * CAST(0.5 AS DOUBLE), 'currency': 'USD'}} AS user_ltv,
  {{'category': {case(f"{u} % 3", {0: "desktop", 1: "mobile", 2: "tablet"})},
    'mobile_brand_name': {case(f"{u} % 3", {1: "Apple", 2: "Samsung"})},
    'mobile_model_name': {case(f"{u} % 3", {1: "iPhone", 2: "Galaxy Tab"})},
    'mobile_marketing_name': {NULL_S}, 'mobile_os_hardware_model': {NULL_L},
    'operating_system': {case(f"{u} % 3", {0: "Windows", 1: "iOS", 2: "Android"})},
    'operating_system_version': 'v' || CAST({u} % 10 AS VARCHAR),
    'vendor_id': {NULL_L}, 'advertising_id': {NULL_L},
    'language': {case(f"{u} % 4", {0: "en-us", 1: "fr-fr", 2: "de-de", 3: "es-es"})},
    'is_limited_ad_tracking': 'No', 'time_zone_offset_seconds': {NULL_L}}} AS device,
  {{'continent': {case(f"{u} % 3", {0: "Americas", 1: "Europe", 2: "Asia"})},
    'country': {case(f"{u} % 4", {0: "United States", 1: "France", 2: "Germany", 3: "Japan"})},
    'region': 'R' || CAST({u} % 7 AS VARCHAR), 'city': 'City ' || CAST({u} % 11 AS VARCHAR),
    'sub_continent': {NULL_S}, 'metro': '(not set)'}} AS geo,
  {{'id': {NULL_S}, 'version': {NULL_S}, 'install_store': {NULL_S}, 'firebase_app_id': {NULL_S},
    'install_source': {NULL_S}}} AS app_info,
  {{'name': {case(f"{u} % 3", {0: "(direct)", 1: "spring_sale", 2: "(organic)"})},
    'medium': {case(f"{u} % 3", {0: "(none)", 1: "cpc", 2: "organic"})},
    'source': {case(f"{u} % 3", {0: "(direct)", 1: "google", 2: "google"})}}} AS traffic_source,
  1000 + {u} % 3 AS stream_id,
  'WEB' AS platform,
  CASE WHEN event_type = 'purchase' THEN {{'total_item_quantity': {e} % 5 + 1, 'purchase_revenue_in_usd': value,
    'purchase_revenue': value, 'refund_value_in_usd': {NULL_D}, 'refund_value': {NULL_D},
    'shipping_value_in_usd': CAST(0.0 AS DOUBLE), 'shipping_value': CAST(0.0 AS DOUBLE),
    'tax_value_in_usd': {NULL_D}, 'tax_value': {NULL_D}, 'unique_items': {e} % 3 + 1,
    'transaction_id': 'T' || CAST({e} AS VARCHAR)}} END AS ecommerce,
  CASE WHEN {e} % 11 = 0 THEN CAST([] AS {ITEM_T}[])
       WHEN {e} % 23 = 0 THEN (CASE WHEN li_items IS NULL THEN NULL ELSE list_append(li_items, CAST(NULL AS {ITEM_T})) END)
       ELSE li_items END AS items
FROM e3),
raw AS (SELECT * FROM raw1 UNION ALL SELECT * FROM raw1 WHERE event_bundle_sequence_id % 10 = 0)"""


def _flat_select(name_for_flags: str = "clean") -> str:
    flags_src = "lower(replace(trim(event_name), ' ', '_'))" if name_for_flags == "clean" else "event_name"
    norm = ("CASE WHEN coalesce(len(items) > 0, false) THEN "
            "list_transform(items, lambda x: {'item_id': x.item_id, 'quantity': x.quantity, 'price': x.price}) "
            f"ELSE [{{'item_id': {NULL_S}, 'quantity': {NULL_L}, 'price': {NULL_D}}}] END")
    return f"""
  try_strptime(event_date, '%Y%m%d')::DATE AS event_date_dt,
  event_timestamp,
  lower(replace(trim(event_name), ' ', '_')) AS event_name,
  privacy_info.analytics_storage AS privacy_info_analytics_storage,
  privacy_info.ads_storage AS privacy_info_ads_storage,
  privacy_info.uses_transient_token AS privacy_info_uses_transient_token,
  user_id, user_pseudo_id, user_first_touch_timestamp,
  user_ltv.revenue AS user_ltv_revenue, user_ltv.currency AS user_ltv_currency,
  device.category AS device_category, device.mobile_brand_name AS device_mobile_brand_name,
  device.mobile_model_name AS device_mobile_model_name, device.mobile_marketing_name AS device_mobile_marketing_name,
  device.mobile_os_hardware_model AS device_mobile_os_hardware_model,
  device.operating_system AS device_operating_system, device.operating_system_version AS device_operating_system_version,
  device.vendor_id AS device_vendor_id, device.advertising_id AS device_advertising_id,
  device.language AS device_language, device.is_limited_ad_tracking AS device_is_limited_ad_tracking,
  device.time_zone_offset_seconds AS device_time_zone_offset_seconds,
  geo.continent AS geo_continent, geo.country AS geo_country, geo.region AS geo_region, geo.city AS geo_city,
  geo.sub_continent AS geo_sub_continent, geo.metro AS geo_metro,
  app_info.id AS app_info_id, app_info.version AS app_info_version, app_info.install_store AS app_info_install_store,
  app_info.firebase_app_id AS app_info_firebase_app_id, app_info.install_source AS app_info_install_source,
  traffic_source.name AS user_campaign, traffic_source.medium AS user_medium, traffic_source.source AS user_source,
  stream_id, platform,
  {{'total_item_quantity': ecommerce.total_item_quantity, 'purchase_revenue_in_usd': ecommerce.purchase_revenue_in_usd,
    'purchase_revenue': ecommerce.purchase_revenue, 'refund_value_in_usd': ecommerce.refund_value_in_usd,
    'refund_value': ecommerce.refund_value, 'shipping_value_in_usd': ecommerce.shipping_value_in_usd,
    'shipping_value': ecommerce.shipping_value, 'tax_value_in_usd': ecommerce.tax_value_in_usd,
    'tax_value': ecommerce.tax_value, 'unique_items': ecommerce.unique_items,
    'transaction_id': ecommerce.transaction_id}} AS ecommerce,
  {norm} AS items,
  {pval('ga_session_id', 'int_value')} AS session_id,
  {pval('page_location')} AS page_location,
  {pval('ga_session_number', 'int_value')} AS session_number,
  {pval('engagement_time_msec', 'int_value')} AS engagement_time_msec,
  {pval('page_title')} AS page_title,
  {pval('page_referrer')} AS page_referrer,
  lower({pval('source')}) AS event_source,
  lower({pval('medium')}) AS event_medium,
  lower({pval('campaign')}) AS event_campaign,
  lower({pval('content')}) AS event_content,
  lower({pval('term')}) AS event_term,
  coalesce({pval('session_engaged', 'int_value')},
           CASE WHEN {pval('session_engaged')} = '1' THEN 1 END) AS session_engaged,
  CASE WHEN {flags_src} = 'page_view' THEN 1 ELSE 0 END AS is_page_view,
  CASE WHEN {flags_src} = 'purchase' THEN 1 ELSE 0 END AS is_purchase,
  CAST(999999999 AS BIGINT) AS property_id,
  event_params,
  event_bundle_sequence_id AS event_id"""


INVALID_URL = "regexp_matches({u}, '[ \"<>{{}}|\\\\^`]')"


def url_host(u: str) -> str:
    return f"CASE WHEN NOT {INVALID_URL.format(u=u)} THEN nullif(regexp_extract({u}, '^[a-zA-Z]+://([^/?#:]+)', 1), '') END"


def url_path(u: str) -> str:
    return f"CASE WHEN NOT {INVALID_URL.format(u=u)} THEN regexp_extract({u}, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) END"


def url_query(u: str) -> str:
    return f"CASE WHEN NOT {INVALID_URL.format(u=u)} THEN nullif(regexp_extract({u}, '^[^#?]*\\?([^#]*)', 1), '') END"


def url_encode(u: str) -> str:
    return f"replace(replace(replace(url_encode({u}), '%20', '+'), '%2A', '*'), '~', '%7E')"


def strip_query(u: str) -> str:
    return f"regexp_replace({u}, '\\?.*$', '')"


def remove_params(u: str, names: list[str]) -> str:
    import re
    if "*all*" in names:
        return strip_query(u)
    alt = "|".join(re.escape(n) for n in names)
    step1 = f"regexp_replace({u}, '\\?(?:(?:{alt})=[^?&#]*&)+', '?', 'g')"
    return f"regexp_replace({step1}, '[?&#](?:{alt})=[^?&#]*', '', 'g')"


def _staged_ctes(source: str = "base") -> str:
    ck = hkey("user_pseudo_id", "CAST(stream_id AS VARCHAR)")
    return f"""
k1 AS (SELECT *, {ck} AS client_key FROM {source}),
k2 AS (SELECT *, {hkey('client_key', 'CAST(session_id AS VARCHAR)')} AS session_key FROM k1),
k3 AS (SELECT *, concat_ws('', session_key, CAST(event_date_dt AS VARCHAR)) AS session_partition_key,
         {hkey('client_key', 'CAST(session_id AS VARCHAR)', 'event_name', 'CAST(event_timestamp AS VARCHAR)', sjson('event_params'))} AS event_key
       FROM k2),
g AS (SELECT * REPLACE (
        CASE WHEN coalesce(contains(page_location, 'gclid'), false) AND event_source IS NULL THEN 'google'
             ELSE event_source END AS event_source,
        CASE WHEN coalesce(contains(page_location, 'gclid'), false) AND (event_medium IS NULL OR event_medium IN ('organic'))
             THEN 'cpc' ELSE event_medium END AS event_medium,
        CASE WHEN coalesce(contains(page_location, 'gclid'), false)
                  AND (event_campaign IS NULL OR event_campaign IN ('organic', '(organic)'))
             THEN '(cpc)' ELSE event_campaign END AS event_campaign),
        page_location AS raw_location
      FROM k3),
u AS (SELECT * REPLACE ({strip_query('page_location')} AS page_location, {strip_query('page_referrer')} AS page_referrer),
        {url_encode('page_location')} AS original_page_location,
        {url_encode('page_referrer')} AS original_page_referrer,
        {url_path('raw_location')} AS page_path,
        {url_host('raw_location')} AS page_hostname,
        {url_query('raw_location')} AS page_query_string
      FROM g),
stg AS (SELECT * EXCLUDE (raw_location),
          concat_ws('', CAST(event_date_dt AS VARCHAR), page_location) AS page_key,
          CASE WHEN event_name = 'page_view' THEN {hkey('session_key', 'page_referrer')}
               ELSE {hkey('session_key', 'page_location')} END AS page_engagement_key
        FROM u)"""


def _fixture_session_key(day: str) -> str:
    """Session key of a (user, day) session under the fixture mapping."""
    return hkey(hkey("CAST(user_id AS VARCHAR) || '.1704067200'", "CAST(1000 + user_id % 3 AS VARCHAR)"),
                f"CAST({day} AS VARCHAR)")


def _session_ctes() -> str:
    traffic_key = _fixture_session_key("CASE WHEN user_id % 2 = 0 THEN day ELSE day + 100000 END")
    derived_key = _fixture_session_key("day")
    return f"""
first_ev AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY session_key
                                 ORDER BY event_timestamp ASC NULLS FIRST, event_key ASC NULLS FIRST) AS rn
    FROM stg WHERE event_name NOT IN ('first_visit', 'session_start')) t WHERE rn = 1),
sess AS (SELECT session_key, event_date_dt AS session_start_date, event_timestamp AS session_start_timestamp,
    page_path AS landing_page_path, page_location AS landing_page, page_hostname AS landing_page_hostname,
    page_referrer AS landing_page_referrer,
    geo_continent, geo_country, geo_region, geo_city, geo_sub_continent, geo_metro, stream_id, platform,
    device_category, device_mobile_brand_name, device_mobile_model_name, device_mobile_marketing_name,
    device_mobile_os_hardware_model, device_operating_system, device_operating_system_version,
    device_vendor_id, device_advertising_id, device_language, device_is_limited_ad_tracking,
    device_time_zone_offset_seconds,
    {NULL_S} AS device_browser, {NULL_S} AS device_web_info_browser, {NULL_S} AS device_web_info_browser_version,
    {NULL_S} AS device_web_info_hostname,
    session_number, session_number = 1 AS is_first_session, user_campaign, user_medium, user_source
  FROM first_ev),
traffic AS (SELECT {traffic_key} AS session_key,
    {case('user_id % 3', {0: 'google', 1: 'bing', 2: 'direct'})} AS session_source,
    {case('user_id % 3', {0: 'cpc', 1: 'organic', 2: '(none)'})} AS session_medium,
    'camp_' || CAST(user_id % 4 AS VARCHAR) AS session_campaign
  FROM (SELECT DISTINCT user_id, {DAY} AS day FROM events) t),
derived AS (SELECT {derived_key} AS session_key, session_event_count, session_last_event_type
  FROM (SELECT user_id, {DAY} AS day, count(*) AS session_event_count, max(event_type) AS session_last_event_type
        FROM events GROUP BY 1, 2) t)"""


def with_layers(tail: str, upto: str = "stg", flags: str = "clean", dedup: bool = True) -> str:
    """``WITH`` the fixture/model layers up to ``upto`` (raw|flat|base|stg|sess), then ``tail``."""
    parts = [_raw_ctes()]
    if upto in ("flat", "base", "stg", "sess"):
        parts.append(f"flat AS (SELECT {_flat_select(flags)}\nFROM raw)")
    if upto in ("base", "stg", "sess"):
        parts.append("""base AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_date_dt, stream_id, user_pseudo_id, session_id, event_name,
                                 event_timestamp, to_json(event_params) ORDER BY event_id) AS rn
    FROM flat) t WHERE rn = 1)""")
    if upto in ("stg", "sess"):
        parts.append(_staged_ctes("base" if dedup else "flat"))
    if upto == "sess":
        parts.append(_session_ctes())
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + tail
