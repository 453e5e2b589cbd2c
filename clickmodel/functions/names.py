from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmodel.functions._util import as_col


def clean_event_name(c: str | Column) -> Column:
    """Trim, turn spaces into underscores, lowercase: ``' Page View '`` -> ``page_view``."""
    return F.lower(F.regexp_replace(F.trim(as_col(c)), " ", "_"))
