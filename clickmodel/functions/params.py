"""Event-parameter access on ``array<struct<key, value: struct<string_value, int_value, ...>>>``.

Lookups work on the row's own array: no explode, no row id, no join, so they run inside the
scan's stage with zero shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmodel.functions._util import as_col


def _sql_literal(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def param_entry(params: str | Column, key: str) -> Column:
    """First entry with ``key`` (NULL when absent or when the array is NULL); duplicate keys
    never raise. ``array_position`` over the array's ``key`` field finds it without a lambda,
    so the lookup stays in generated code."""
    if isinstance(params, str) and params.isidentifier():
        # same expression as SQL text: one call to the JVM instead of one per node
        return F.expr(f"get(`{params}`, array_position(`{params}`.key, {_sql_literal(key)}) - 1)")
    arr = as_col(params)
    return F.get(arr, F.array_position(arr["key"], F.lit(key)) - 1)


def param_value(params: str | Column, key: str, field: str = "string_value") -> Column:
    if isinstance(params, str) and params.isidentifier() and field.isidentifier():
        return F.expr(f"get(`{params}`, array_position(`{params}`.key, {_sql_literal(key)}) - 1).value.`{field}`")
    return param_entry(params, key)["value"][field]


def session_engaged(params: str | Column = "event_params") -> Column:
    """``int_value``, else 1 when the string value is ``'1'``."""
    return F.coalesce(param_value(params, "session_engaged", "int_value"),
                      F.when(param_value(params, "session_engaged", "string_value") == "1", F.lit(1)))


def dedupe_entries(params: str | Column) -> Column:
    """Drop NULL entries / NULL keys and every repeat of a key after its first occurrence."""
    arr = F.filter(as_col(params), lambda x: x.isNotNull() & x["key"].isNotNull())
    keys = F.transform(arr, lambda x: x["key"])
    return F.filter(arr, lambda x, i: F.array_position(keys, x["key"]) == i + 1)


def params_map(params: str | Column = "event_params", on_duplicate: str = "first") -> Column:
    """``map<key, value>`` from the entries.

    ``on_duplicate="first"`` keeps the first of repeated keys; ``"error"`` keeps Spark's
    default (a repeated or NULL key fails the query).
    """
    arr = as_col(params)
    if on_duplicate == "first":
        arr = dedupe_entries(arr)
    elif on_duplicate != "error":
        raise ValueError("on_duplicate must be 'first' or 'error'")
    return F.map_from_entries(F.transform(arr, lambda x: F.struct(x["key"], x["value"])))
