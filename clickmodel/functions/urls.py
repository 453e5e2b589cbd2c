from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmodel.functions._util import as_col

ALL_PARAMS = "*all*"


def strip_query(c: str | Column) -> Column:
    """Remove everything from the first ``?``; a fragment without ``?`` is kept."""
    return F.regexp_replace(as_col(c), r"\?.*$", "")


def encode_url(c: str | Column) -> Column:
    """``application/x-www-form-urlencoded`` encoding (space -> ``+``)."""
    return F.url_encode(as_col(c))


def url_part(c: str | Column, part: str) -> Column:
    """HOST / PATH / QUERY / ... of a URL; NULL for text that is not a valid URI."""
    return F.try_parse_url(as_col(c), F.lit(part))


def remove_query_params(c: str | Column, exclusions: Sequence[str]) -> Column:
    """Remove the named query parameters (``name=value`` after ``?``, ``&`` or ``#``).

    ``["*all*"]`` removes the whole query string. A removed parameter that directly follows
    ``?`` hands the ``?`` on to the next parameter.
    """
    c = as_col(c)
    names = [e for e in exclusions if e]
    if not names:
        return c
    if ALL_PARAMS in names:
        return strip_query(c)
    alt = "|".join(re.escape(n) for n in names)
    c = F.regexp_replace(c, rf"\?(?:(?:{alt})=[^?&#]*&)+", "?")
    return F.regexp_replace(c, rf"[?&#](?:{alt})=[^?&#]*", "")
