"""User-snapshot projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.functions.dates import parse_yyyymmdd

# Fixed values: (struct, field, output name). ``device_unified_sceen_name`` keeps the
# established (misspelt) warehouse column name.
USER_SNAPSHOT_FIELDS = [
    ("user_info", "last_active_timestamp_micros", "user_info_last_active_timestamp_micros"),
    ("user_info", "user_first_touch_timestamp_micros", "user_info_user_first_touch_timestamp_micros"),
    ("user_info", "first_purchase_date", "user_info_first_purchase_date"),
    ("device", "operating_system", "device_operating_system"),
    ("device", "category", "device_category"),
    ("device", "mobile_brand_name", "device_mobile_brand_name"),
    ("device", "mobile_model_name", "device_mobile_model_name"),
    ("device", "unified_screen_name", "device_unified_sceen_name"),
    ("geo", "city", "geo_city"),
    ("geo", "country", "geo_country"),
    ("geo", "continent", "geo_continent"),
    ("geo", "region", "geo_region"),
    ("user_ltv", "revenue_in_usd", "user_ltv_revenue_in_usd"),
    ("user_ltv", "sessions", "user_ltv_sessions"),
    ("user_ltv", "engagement_time_millis", "user_ltv_engagement_time_millis"),
    ("user_ltv", "purchases", "user_ltv_purchases"),
    ("user_ltv", "engaged_sessions", "user_ltv_engaged_sessions"),
    ("user_ltv", "session_duration_micros", "user_ltv_session_duration_micros"),
    ("predictions", "in_app_purchase_score_7d", "predictions_in_app_purchase_score_7d"),
    ("predictions", "purchase_score_7d", "predictions_purchase_score_7d"),
    ("predictions", "churn_score_7d", "predictions_churn_score_7d"),
    ("predictions", "revenue_28d_in_usd", "predictions_revenue_28d_in_usd"),
    ("privacy_info", "is_limited_ad_tracking", "privacy_info_is_limited_ad_tracking"),
    ("privacy_info", "is_ads_personalization_allowed", "privacy_info_is_ads_personalization_allowed"),
]


def user_snapshot(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f"{s}.{f}").alias(a) for s, f, a in USER_SNAPSHOT_FIELDS],
        parse_yyyymmdd("occurrence_date").alias("occurrence_date"),
        parse_yyyymmdd("last_updated_date").alias("last_updated_date"),
        "user_properties", "audiences",
    )
