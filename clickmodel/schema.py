"""Declared types of the members that the model reads. An export may hold more, and may lack
some: ``sources.files.read_days`` keeps the rest as it is and fills what is missing."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
# A member whose type is the export's own: exports hold the privacy flags as numbers or as text.
AS_FOUND = T.NullType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PARAM_VALUE = _struct(("string_value", S), ("int_value", L))
PARAM = _struct(("key", S), ("value", PARAM_VALUE))
PARAMS = T.ArrayType(PARAM, True)
ITEM = _struct(("item_id", S), ("quantity", L), ("price", D))
ITEMS = T.ArrayType(ITEM, True)

PRIVACY_INFO = _struct(("analytics_storage", AS_FOUND), ("ads_storage", AS_FOUND), ("uses_transient_token", S))
USER_LTV = _struct(("revenue", D), ("currency", S))
DEVICE = _struct(("category", S), ("mobile_brand_name", S), ("mobile_model_name", S),
                 ("mobile_marketing_name", S), ("mobile_os_hardware_model", L), ("operating_system", S),
                 ("operating_system_version", S), ("vendor_id", L), ("advertising_id", L),
                 ("language", S), ("is_limited_ad_tracking", S), ("time_zone_offset_seconds", L))
GEO = _struct(("continent", S), ("country", S), ("region", S), ("city", S), ("sub_continent", S),
              ("metro", S))
APP_INFO = _struct(("id", S), ("version", S), ("install_store", S), ("firebase_app_id", S),
                   ("install_source", S))
TRAFFIC_SOURCE = _struct(("name", S), ("medium", S), ("source", S))
ECOMMERCE_FIELDS = [("total_item_quantity", L), ("purchase_revenue_in_usd", D), ("purchase_revenue", D),
                    ("refund_value_in_usd", D), ("refund_value", D), ("shipping_value_in_usd", D),
                    ("shipping_value", D), ("tax_value_in_usd", D), ("tax_value", D), ("unique_items", L),
                    ("transaction_id", S)]
ECOMMERCE = _struct(*ECOMMERCE_FIELDS)

RAW_EVENT = _struct(
    ("event_date", S), ("event_timestamp", L), ("event_name", S), ("event_params", PARAMS),
    ("event_previous_timestamp", L), ("event_value_in_usd", D), ("event_bundle_sequence_id", L),
    ("event_server_timestamp_offset", L), ("user_id", S), ("user_pseudo_id", S),
    ("privacy_info", PRIVACY_INFO), ("user_properties", PARAMS), ("user_first_touch_timestamp", L),
    ("user_ltv", USER_LTV), ("device", DEVICE), ("geo", GEO), ("app_info", APP_INFO),
    ("traffic_source", TRAFFIC_SOURCE), ("stream_id", L), ("platform", S), ("ecommerce", ECOMMERCE),
    ("items", ITEMS),
)
