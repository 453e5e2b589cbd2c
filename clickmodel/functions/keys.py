"""Surrogate keys: base64 of the binary MD5 of the concatenated parts (24 characters).

Parts are joined with no separator and NULL parts are skipped (``concat_ws('')``), so keys
stay byte-compatible with existing warehouses; collisions such as ``ab|c`` vs ``a|bc`` or an
all-NULL key are reported by ``operators.quality.unique_violations``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmodel.functions._util import as_col, as_text


def hash_key(*parts: str | Column) -> Column:
    return F.base64(F.unhex(F.md5(F.concat_ws("", *[as_text(p) for p in parts]))))


def client_key(user_pseudo_id="user_pseudo_id", stream_id="stream_id") -> Column:
    return hash_key(user_pseudo_id, stream_id)


def session_key(client="client_key", session_id="session_id") -> Column:
    return hash_key(client, session_id)


def session_partition_key(session="session_key", date="event_date_dt") -> Column:
    return F.concat_ws("", as_text(session), as_text(date))


def event_key(client="client_key", session_id="session_id", name="event_name",
              timestamp="event_timestamp", params="event_params") -> Column:
    return hash_key(client, session_id, name, timestamp, F.to_json(as_col(params)))


def page_key(date="event_date_dt", location="page_location") -> Column:
    return F.concat_ws("", as_text(date), as_text(location))


def page_engagement_key(name="event_name", session="session_key", referrer="page_referrer",
                        location="page_location") -> Column:
    """Engagement time arriving on a page_view belongs to the previous page (the referrer)."""
    return F.when(as_col(name) == "page_view", hash_key(session, referrer)) \
        .otherwise(hash_key(session, location))
