"""Column-level expressions. All are built-in Spark SQL functions (JVM side, codegen'd)."""

from clickmodel.functions.dates import parse_yyyymmdd
from clickmodel.functions.keys import (client_key, event_key, hash_key, page_engagement_key, page_key,
                                       session_key, session_partition_key)
from clickmodel.functions.names import clean_event_name
from clickmodel.functions.params import dedupe_entries, param_value, params_map, session_engaged
from clickmodel.functions.urls import encode_url, remove_query_params, strip_query, url_part

__all__ = [
    "parse_yyyymmdd", "hash_key", "client_key", "session_key", "session_partition_key", "event_key",
    "page_key", "page_engagement_key", "clean_event_name", "param_value", "params_map",
    "dedupe_entries", "session_engaged", "encode_url", "strip_query", "url_part", "remove_query_params",
]
