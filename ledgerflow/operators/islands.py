"""Gaps-and-islands over days (G1).

``sessionize_days`` numbers runs of dates per key where consecutive dates are
at most ``max_gap`` days apart. ``day_periods`` turns raw events into
periods: events are first reduced to distinct (key, group columns, day) rows
by a grouped aggregate (combined map-side), so a key with a large share of
the events still contributes at most one row per day and code to the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessionize_days(df: DataFrame, keys: Sequence[str], date_col: str,
                    max_gap: int = 1, group_col: str = "grp") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(date_col)
    prev = F.lag(date_col).over(w)
    new = F.when(prev.isNull() | (F.datediff(F.col(date_col), prev) > max_gap), 1).otherwise(0)
    return (df.withColumn("_new", new)
            .withColumn(group_col, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("_new"))


def day_periods(events: DataFrame, window_keys: Sequence[str], period_keys: Sequence[str],
                date_col: str, group_col: str, start_col: str, end_col: str,
                max_gap: int = 1) -> DataFrame:
    """Periods per ``period_keys`` + island, islands numbered per ``window_keys``."""
    days = events.select(*period_keys, date_col).distinct()
    grouped = sessionize_days(days, window_keys, date_col, max_gap, group_col)
    return (grouped.groupBy(*period_keys, group_col)
            .agg(F.min(date_col).alias(start_col), F.max(date_col).alias(end_col)))


def close_last_period(periods: DataFrame, keys: Sequence[str], end_col: str,
                      flag_col: str) -> DataFrame:
    """The period(s) ending on the key's latest end date are open-ended and current (W4)."""
    latest = F.max(end_col).over(Window.partitionBy(*keys))
    is_last = F.col(end_col) == latest
    return (periods.withColumn(flag_col, F.coalesce(is_last, F.lit(False)))
            .withColumn(end_col, F.when(is_last, F.lit(None)).otherwise(F.col(end_col))))
