"""Session dimension: one row per session, from its first non-boundary event."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.operators.dedup import first_per_group
from clickmodel.operators.joins import left_join

# Events that mark a session boundary rather than user activity.
BOUNDARY_EVENTS = ["first_visit", "session_start"]

# Columns some exports carry and others lack; typed NULL when absent.
OPTIONAL_DEVICE_COLUMNS = ["device_browser", "device_web_info_browser", "device_web_info_browser_version",
                           "device_web_info_hostname"]


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def window_bounds(start=None, days: int | None = None, direction: str = "forward",
                  start_only: str = "from") -> tuple[dt.date | None, dt.date | None]:
    """First and last day of a window, None where it is open."""
    if start is None:
        if days is not None:
            raise ValueError("days needs a start date")
        return None, None
    s = _as_date(start)
    if days is None:
        return s, s if start_only == "exact" else None
    if days < 1:
        raise ValueError("days must be >= 1")
    return (s, s + dt.timedelta(days=days - 1)) if direction == "forward" else (s - dt.timedelta(days=days - 1), s)


def date_window(df: DataFrame, start=None, days: int | None = None, column: str = "event_date_dt",
                direction: str = "forward", start_only: str = "from") -> DataFrame:
    """Filter on a (partition) date column.

    (start, days): ``days`` dates from ``start`` inclusive, forward or back.
    start only: ``start_only="from"`` keeps ``>= start``; ``"exact"`` keeps ``== start``.
    Nothing: no filter. The predicate reaches the scan as a partition filter.
    """
    lo, hi = window_bounds(start, days, direction, start_only)
    c = F.col(column)
    if lo is None:
        return df
    if lo == hi:
        return df.filter(c == F.lit(lo))
    return df.filter(c >= F.lit(lo)) if hi is None else df.filter((c >= F.lit(lo)) & (c <= F.lit(hi)))


def date_window_exact(df: DataFrame, start=None, days: int | None = None,
                      column: str = "event_date_dt") -> DataFrame:
    return date_window(df, start, days, column=column, start_only="exact")


def drop_boundary_events(df: DataFrame, name: str = "event_name") -> DataFrame:
    """Drop session boundary events; rows with a NULL name are dropped too."""
    return df.filter(~F.col(name).isin(*BOUNDARY_EVENTS))


def first_event_per_session(df: DataFrame, key: str = "session_key",
                            order: Sequence[str] = ("event_timestamp", "event_key")) -> DataFrame:
    """Earliest event of each session; ties broken by ``event_key`` (deterministic)."""
    return first_per_group(df, [key], [F.col(c).asc_nulls_first() for c in order])


def is_first_session(number: str = "session_number"):
    return F.col(number) == F.lit(1)


def session_start(df: DataFrame) -> DataFrame:
    """Project the first event of each session to session-start attributes."""
    missing = {c: F.lit(None).cast("string") for c in OPTIONAL_DEVICE_COLUMNS if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    # The columns of the session dimension, in its order.
    return df.select(
        "session_key",
        F.col("event_date_dt").alias("session_start_date"),
        F.col("event_timestamp").alias("session_start_timestamp"),
        F.col("page_path").alias("landing_page_path"),
        F.col("page_location").alias("landing_page"),
        F.col("page_hostname").alias("landing_page_hostname"),
        F.col("page_referrer").alias("landing_page_referrer"),
        "geo_continent", "geo_country", "geo_region", "geo_city", "geo_sub_continent", "geo_metro",
        "stream_id", "platform",
        "device_category", "device_mobile_brand_name", "device_mobile_model_name",
        "device_mobile_marketing_name", "device_mobile_os_hardware_model",
        "device_operating_system", "device_operating_system_version",
        "device_vendor_id", "device_advertising_id", "device_language",
        "device_is_limited_ad_tracking", "device_time_zone_offset_seconds",
        *OPTIONAL_DEVICE_COLUMNS,
        "session_number",
        is_first_session().alias("is_first_session"),
        "user_campaign", "user_medium", "user_source",
    )


def session_traffic(sessions: DataFrame, traffic: DataFrame, key: str = "session_key",
                    repeated_keys: bool = False) -> DataFrame:
    """Attach session traffic sources (left join: sessions without a match get NULLs).
    ``repeated_keys``: see ``operators.joins.left_join``."""
    return left_join(sessions, traffic, key, repeated_keys)


def session_derived(sessions: DataFrame, derived: DataFrame | None, join_derived: bool = False,
                    key: str = "session_key", repeated_keys: bool = False) -> DataFrame:
    if not (join_derived and derived is not None):
        return sessions
    return left_join(sessions, derived, key, repeated_keys)


def drop_continued(sessions: DataFrame, earlier: DataFrame, key: str = "session_key") -> DataFrame:
    """Sessions that ``earlier`` rows of the session dimension do not hold; only keys are compared."""
    return sessions.join(earlier.select(key), key, "left_anti")


def build_sessions(staged: DataFrame, traffic: DataFrame | None = None, derived: DataFrame | None = None,
                   start=None, days: int | None = None, join_derived: bool = False,
                   earlier: DataFrame | None = None) -> DataFrame:
    """Staged events -> session dimension. ``traffic`` and ``derived`` hold one row per session;
    sessions that ``earlier`` holds are left out (they began before)."""
    df = session_start(first_event_per_session(drop_boundary_events(date_window_exact(staged, start, days))))
    if earlier is not None:
        df = drop_continued(df, earlier)
    if traffic is not None:
        df = session_traffic(df, traffic)
    return session_derived(df, derived, join_derived)
