"""Serving projection for a relational warehouse: fixed 68-column contract, nested
columns as JSON text, numeric columns coerced (bad values -> NULL)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse column contract (name, SQL type) in table order.
SERVING_COLUMNS = [
    ("event_key", "string"), ("_event_date_dt", "date"), ("event_timestamp", "bigint"),
    ("event_name", "string"), ("privacy_info_analytics_storage", "int"), ("privacy_info_ads_storage", "int"),
    ("privacy_info_uses_transient_token", "string"), ("user_id", "string"), ("user_pseudo_id", "string"),
    ("user_first_touch_timestamp", "bigint"), ("user_ltv_revenue", "double"), ("user_ltv_currency", "string"),
    ("device_category", "string"), ("device_mobile_brand_name", "string"), ("device_mobile_model_name", "string"),
    ("device_mobile_marketing_name", "string"), ("device_mobile_os_hardware_model", "bigint"),
    ("device_operating_system", "string"), ("device_operating_system_version", "string"),
    ("device_vendor_id", "bigint"), ("device_advertising_id", "bigint"), ("device_language", "string"),
    ("device_is_limited_ad_tracking", "string"), ("device_time_zone_offset_seconds", "bigint"),
    ("geo_continent", "string"), ("geo_country", "string"), ("geo_region", "string"), ("geo_city", "string"),
    ("geo_sub_continent", "string"), ("geo_metro", "string"), ("app_info_id", "string"),
    ("app_info_version", "string"), ("app_info_install_store", "string"), ("app_info_firebase_app_id", "string"),
    ("app_info_install_source", "string"), ("user_campaign", "string"), ("user_medium", "string"),
    ("user_source", "string"), ("stream_id", "bigint"), ("platform", "string"), ("ecommerce", "json"),
    ("items", "json"), ("session_id", "bigint"), ("page_location", "string"), ("session_number", "int"),
    ("engagement_time_msec", "bigint"), ("page_title", "string"), ("page_referrer", "string"),
    ("event_source", "string"), ("event_medium", "string"), ("event_campaign", "string"),
    ("event_content", "string"), ("event_term", "string"), ("session_engaged", "bigint"),
    ("is_page_view", "int"), ("is_purchase", "int"), ("property_id", "bigint"), ("event_params", "json"),
    ("client_key", "string"), ("session_key", "string"), ("session_partition_key", "string"),
    ("original_page_location", "string"), ("original_page_referrer", "string"), ("page_path", "string"),
    ("page_hostname", "string"), ("page_query_string", "string"), ("page_key", "string"),
    ("page_engagement_key", "string"),
]


# The columns coerced to whole numbers before the load.
COERCED = ["event_timestamp", "user_first_touch_timestamp", "device_time_zone_offset_seconds", "device_vendor_id",
           "device_advertising_id", "stream_id", "session_id", "engagement_time_msec", "session_engaged", "property_id"]


def whole_number(c: Column, kind: T.DataType) -> Column:
    """``c`` as bigint where it is a whole number in any numeric or text form, else NULL."""
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("bigint")
    exact = c.cast("string").try_cast("decimal(38,9)")  # also for doubles: their shortest text
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def serving_projection(staged: DataFrame) -> DataFrame:
    """Staged events -> the warehouse row shape.

    ``_event_date_dt`` falls back to ``event_date_dt`` when the copy is absent. The ten coerced
    columns load malformed values as NULL; all others keep the export's value. JSON text holds
    NULL members as ``null``.
    """
    cols = []
    for name, typ in SERVING_COLUMNS:
        src = "event_date_dt" if name == "_event_date_dt" and name not in staged.columns else name
        c = F.col(src)
        if typ == "json":
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif name in COERCED:
            c = whole_number(c, staged.schema[src].dataType)
        cols.append(c.alias(name))
    return staged.select(*cols)
