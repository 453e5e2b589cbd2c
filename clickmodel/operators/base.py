"""Base event model: source projection, flatten/rename, flags and ecommerce repack.

All of it is one narrow projection over the scan: Catalyst collapses the steps into a single
``Project`` inside the Parquet scan's codegen stage and prunes nested fields that are not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmodel.functions.dates import parse_yyyymmdd
from clickmodel.functions.names import clean_event_name
from clickmodel.operators.dedup import DEDUP_KEYS, dedup_events
from clickmodel.operators.items import normalized_items
from clickmodel.operators.params import param_columns
from clickmodel.schema import ECOMMERCE_FIELDS

# Fixed value: constant property id written into every base row.
DUMMY_PROPERTY_ID = 999999999

ECOMMERCE_COLUMNS = [n for n, _ in ECOMMERCE_FIELDS]

SOURCE_COLUMNS = [
    "event_timestamp", "event_name", "event_params", "event_previous_timestamp", "event_value_in_usd",
    "event_bundle_sequence_id", "event_server_timestamp_offset", "user_id", "user_pseudo_id",
    "privacy_info", "user_properties", "user_first_touch_timestamp", "user_ltv", "device", "geo",
    "app_info", "traffic_source", "stream_id", "platform",
]

# Nested struct -> flattened column names, in base-table order.
FLAT_STRUCT_FIELDS = dict([
    ("privacy_info", ["analytics_storage", "ads_storage", "uses_transient_token"]),
    ("user_ltv", ["revenue", "currency"]),
    ("device", ["category", "mobile_brand_name", "mobile_model_name", "mobile_marketing_name",
                "mobile_os_hardware_model", "operating_system", "operating_system_version", "vendor_id",
                "advertising_id", "language", "is_limited_ad_tracking", "time_zone_offset_seconds"]),
    ("geo", ["continent", "country", "region", "city", "sub_continent", "metro"]),
    ("app_info", ["id", "version", "install_store", "firebase_app_id", "install_source"]),
])
# Members of ``device`` that only some exports have -> base columns.
OPTIONAL_DEVICE = {"browser": "device_browser", "web_info.browser": "device_web_info_browser",
                   "web_info.browser_version": "device_web_info_browser_version",
                   "web_info.hostname": "device_web_info_hostname"}
# traffic_source describes the user's first acquisition, hence the user_ prefix.
TRAFFIC_RENAMES = [("name", "user_campaign"), ("medium", "user_medium"), ("source", "user_source")]


def select_source(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pick the raw columns, parse ``event_date`` (bad text -> NULL), lift the ecommerce
    scalars to top level and add the constant ``property_id``."""
    return df.select(
        parse_yyyymmdd("event_date").alias("event_date_dt"),
        *SOURCE_COLUMNS,
        *[F.col(f"ecommerce.{n}").alias(n) for n in ECOMMERCE_COLUMNS],
        "items",
        F.lit(DUMMY_PROPERTY_ID).cast("long").alias("property_id"),
        *keep,
    )


def ecommerce_repack(df: DataFrame, alias: str = "ecommerce", drop: bool = True) -> DataFrame:
    """Pack the 11 lifted ecommerce scalars back into one struct."""
    out = df.withColumn(alias, F.struct(*[F.col(n) for n in ECOMMERCE_COLUMNS]))
    return out.drop(*ECOMMERCE_COLUMNS) if drop else out


def flag(name: Column, value: str) -> Column:
    return F.when(name == value, F.lit(1)).otherwise(F.lit(0))


def flatten_event(df: DataFrame, raw_name_flags: bool = False, keep_empty_items: bool = False,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Source projection output -> base event columns (57), in base-table order.

    ``raw_name_flags=True`` computes the flags from the uncleaned name (so ``' Page View '``
    is not a page view), as the original job did; by default the cleaned name is used.
    ``keep`` carries extra input columns through (e.g. an id for tests).
    """
    items = normalized_items(df, keep_empty=keep_empty_items)
    params = param_columns()
    clean = clean_event_name("event_name")
    flag_src = F.col("event_name") if raw_name_flags else clean
    return df.select(
        "event_date_dt", "event_timestamp", clean.alias("event_name"),
        *_members("privacy_info"),
        "user_id", "user_pseudo_id", "user_first_touch_timestamp",
        *[c for s in ("user_ltv", "device", "geo", "app_info") for c in _members(s)],
        *[F.col(f"traffic_source.{f}").alias(a) for f, a in TRAFFIC_RENAMES],
        "stream_id", "platform",
        F.struct(*[F.col(n) for n in ECOMMERCE_COLUMNS]).alias("ecommerce"),
        (F.col("items") if items is None else items).alias("items"),
        *[params[c].alias(c) for c in ("session_id", "page_location", "session_number", "engagement_time_msec",
                                       "page_title", "page_referrer", "event_source", "event_medium",
                                       "event_campaign", "event_content", "event_term", "session_engaged")],
        flag(flag_src, "page_view").alias("is_page_view"),
        flag(flag_src, "purchase").alias("is_purchase"),
        "property_id",
        "event_params",
        *optional_device(df),
        *keep,
    )


def _members(struct: str) -> list[Column]:
    return [F.col(f"{struct}.{f}").alias(f"{struct}_{f}") for f in FLAT_STRUCT_FIELDS[struct]]


def optional_device(df: DataFrame) -> list[Column]:
    """The optional device members that this export has."""
    def has(kind: T.DataType, path: list[str]) -> bool:
        if not path:
            return True
        return isinstance(kind, T.StructType) and path[0] in kind.names and has(kind[path[0]].dataType, path[1:])
    return [F.col(f"device.{m}").alias(a) for m, a in OPTIONAL_DEVICE.items() if has(df.schema, ["device", *m.split(".")])]


def dedup_source(source: DataFrame, by_day: bool = False) -> DataFrame:
    """Deduplicate raw rows before they are flattened: the shuffle carries each raw row and the
    two key columns that only flattening would make, not the flattened copies. ``by_day``: each
    task's rows come in the order of their days."""
    keyed = source.withColumns({"__name": clean_event_name("event_name"), "__session": param_columns()["session_id"]})
    keys = [{"event_name": "__name", "session_id": "__session"}.get(k, k) for k in DEDUP_KEYS]
    return dedup_events(keyed, keys, lead=["event_date_dt"] if by_day else []).drop("__name", "__session")


def base_model(raw: DataFrame, raw_name_flags: bool = False, keep: Sequence[str] = (), by_day: bool = False) -> DataFrame:
    """Raw daily rows -> deduplicated base events; rows without a date are kept (NULL day). ``by_day``:
    each task's rows come in the order of their days, for ``write_partitioned(dealt=True)``."""
    return flatten_event(dedup_source(select_source(raw, keep=keep), by_day), raw_name_flags=raw_name_flags, keep=keep)


def base_events(raw: DataFrame, raw_name_flags: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Raw daily rows -> flattened base rows (before dedup)."""
    return flatten_event(select_source(raw, keep=keep), raw_name_flags=raw_name_flags, keep=keep)
