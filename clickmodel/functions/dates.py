from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmodel.functions._util import as_col


def parse_yyyymmdd(c: str | Column) -> Column:
    """``yyyyMMdd`` text -> DATE; malformed text gives NULL instead of failing the job (ANSI)."""
    return F.try_to_date(as_col(c), "yyyyMMdd")
