"""``items`` (array<struct>) operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def item_fields(schema: T.StructType, column: str) -> T.StructType | None:
    """The fields of an item by the frame's declared type; None for any other type."""
    if column not in schema.names:
        return None
    kind = schema[column].dataType
    is_items = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)
    return kind.elementType if is_items else None


def normalized_items(df: DataFrame, column: str = "items", keep_empty: bool = False) -> Column | None:
    """The normalised ``items`` column expression, or None when the column is missing or not an
    array of structs (see ``normalize_items``)."""
    elem = item_fields(df.schema, column)
    if elem is None:
        return None
    names = [f.name for f in elem.fields]
    rebuilt = F.transform(F.col(column), lambda x: F.struct(*[x[n].alias(n) for n in names]))
    if keep_empty:
        return rebuilt
    empty_row = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in elem.fields]))
    return F.when(F.coalesce(F.size(F.col(column)) > 0, F.lit(False)), rebuilt).otherwise(empty_row)


def normalize_items(df: DataFrame, column: str = "items", keep_empty: bool = False) -> DataFrame:
    """Rebuild each item as a struct of its declared fields, per row, without a shuffle.

    NULL elements become a struct of NULLs. A NULL or empty array becomes ``[struct of NULLs]``
    (the explode_outer/collect_list contract) unless ``keep_empty`` keeps it as it is.
    No-op when the column is missing or not an array of structs.
    """
    c = normalized_items(df, column, keep_empty)
    return df if c is None else df.withColumn(column, c)


def explode_items(df: DataFrame, column: str = "items", alias: str = "item",
                  position: str | None = "item_index") -> DataFrame:
    """One row per item; rows with NULL/empty arrays are kept once with NULL item."""
    if position:
        return df.select("*", F.posexplode_outer(column).alias(position, alias)).drop(column)
    return df.select("*", F.explode_outer(column).alias(alias)).drop(column)


def collect_items(df: DataFrame, keys: list[str], item: str = "item", order: str | None = "item_index",
                  alias: str = "items") -> DataFrame:
    """Inverse of ``explode_items``: one array per key, in ``order`` when given.

    Group size is bounded by the source arrays (an event's item list), so the per-key array
    fits one task; NULL items (from empty arrays) are dropped by ``collect_list``.
    """
    if order:
        # rows from NULL/empty arrays carry a NULL position and are skipped; a NULL element
        # of a non-empty array keeps its slot.
        entry = F.when(F.col(order).isNotNull(), F.struct(F.col(order).alias("o"), F.col(item).alias("v")))
        agg = F.sort_array(F.collect_list(entry))
        return df.groupBy(*keys).agg(F.transform(agg, lambda x: x["v"]).alias(alias))
    return df.groupBy(*keys).agg(F.collect_list(item).alias(alias))
