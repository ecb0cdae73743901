"""Surrogate keys.

A key is the MD5 of the listed columns, each cast to string with nulls
replaced by a marker, joined by '-'. It is a pure column expression, so it
stays inside whole-stage codegen and needs no lookup table or sequence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and null marker of the key text.
KEY_SEPARATOR = "-"
KEY_NULL_MARKER = "_null_"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 over the string form of ``cols`` (names or Columns)."""
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(KEY_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def surrogate_key_sql(*exprs: str) -> str:
    """The same key as SQL text, for callers that write SQL."""
    parts = [f"coalesce(cast({e} as varchar), '{KEY_NULL_MARKER}')" for e in exprs]
    return f"md5(concat_ws('{KEY_SEPARATOR}', {', '.join(parts)}))"
