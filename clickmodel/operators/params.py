"""Event-parameter operators (all narrow: no explode/join, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmodel.functions.params import param_value, params_map, session_engaged

# (output column, parameter key, value field, lowercase?) -- fixed values: the parameter keys
# and output names the base model extracts.
EXTRACTED_PARAMS = [
    ("page_location", "page_location", "string_value", False),
    ("session_id", "ga_session_id", "int_value", False),
    ("session_number", "ga_session_number", "int_value", False),
    ("engagement_time_msec", "engagement_time_msec", "int_value", False),
    ("page_title", "page_title", "string_value", False),
    ("page_referrer", "page_referrer", "string_value", False),
    ("event_source", "source", "string_value", True),
    ("event_medium", "medium", "string_value", True),
    ("event_campaign", "campaign", "string_value", True),
    ("event_content", "content", "string_value", True),
    ("event_term", "term", "string_value", True),
]


def unnest_key(df: DataFrame, column: str, key: str, value_type: str = "string_value",
               alias: str | None = None) -> DataFrame:
    """One parameter as a column. Rows without the key are kept with NULL; a key present k
    times yields k rows (one per occurrence), like explode + left join, but as a single
    ``explode_outer`` over the filtered array -- no row id and no shuffle."""
    out = alias or key
    field = "string_value" if value_type == "lower_string_value" else value_type
    matches = F.filter(F.col(column), lambda x: x["key"] == F.lit(key))
    tmp = f"__{out}_entry"
    res = df.withColumn(tmp, F.explode_outer(matches))
    val = F.col(f"{tmp}.value.{field}")
    if value_type == "lower_string_value":
        val = F.lower(val)
    return res.withColumn(out, val).drop(tmp)


def with_params_map(df: DataFrame, column: str = "event_params", alias: str = "params_map",
                    on_duplicate: str = "first") -> DataFrame:
    return df.withColumn(alias, params_map(column, on_duplicate))


def param_columns(column: str = "event_params") -> dict[str, Column]:
    """The 11 named parameters plus ``session_engaged``; first occurrence of a key wins."""
    cols = {}
    for out, key, field, lower in EXTRACTED_PARAMS:
        v = param_value(column, key, field)
        cols[out] = F.lower(v) if lower else v
    cols["session_engaged"] = session_engaged(column)
    return cols


def extract_params(df: DataFrame, column: str = "event_params") -> DataFrame:
    """Add the 11 named parameters plus ``session_engaged``."""
    return df.withColumns(param_columns(column))
