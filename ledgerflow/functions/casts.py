"""Casts.

``safe_cast`` returns null for a value that does not convert, where a plain
cast raises under ANSI mode (Spark's default); use it on raw text inputs such
as staged CSV columns read as strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(c, data_type: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(data_type)
