"""Calendar operators (K1-K6).

The calendar is bounded by its date range (one row per day), never by data
volume, so it is the one relation the jobs broadcast freely; its
unpartitioned windows (previous business day, business-day numbering) run
over those few thousand rows only, never over facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The reference calendar range (end exclusive) and its defaults.
CALENDAR_START = dt.date(2010, 1, 1)
CALENDAR_END = dt.date(2035, 12, 31)
HISTORY_DEFAULT_START = dt.date(2000, 1, 1)
HISTORY_LOOKBACK_DAYS = 5


def _lit_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def date_spine_from(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Days from ``start`` up to ``end`` exclusive, for a one-row bounds frame."""
    return bounds.select(F.explode(F.sequence(F.col(start_col), F.date_sub(F.col(end_col), 1)))
                         .alias("date_day"))


def date_spine(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(_lit_date(start).alias("start"), _lit_date(end).alias("end"))
    return date_spine_from(bounds)


def calendar_from_spine(spine: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    d = F.col("date_day")
    if holidays is not None:
        h = F.broadcast(holidays.select(F.col("holiday_date")).distinct())
        spine = spine.join(h, d == F.col("holiday_date"), "left")
        hol = F.col("holiday_date").isNotNull()
    else:
        hol = F.lit(False)
    dow = F.dayofweek(d)  # Sunday = 1
    weekend = dow.isin(1, 7)
    return spine.select(
        d.alias("cal_date"), d.alias("date_day"),
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"), F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMM").alias("month_name"),
        weekend.alias("is_weekend"), hol.alias("is_holiday"),
        (~weekend & ~hol).alias("is_business_day"))


def dim_calendar(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END,
                 holidays: DataFrame | None = None) -> DataFrame:
    return calendar_from_spine(date_spine(spark, start, end), holidays)


def business_date(ts: Column | str, timezone: str = "UTC", cutoff_hour: int = 0) -> Column:
    """Business date of a UTC timestamp: the local date, or the day before when
    the local hour is before ``cutoff_hour``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    local = F.from_utc_timestamp(t.cast("timestamp"), timezone) if timezone != "UTC" else t
    day = local.cast("date")
    return F.when(F.hour(local) < cutoff_hour, F.date_sub(day, 1)).otherwise(day)


def business_day_index(calendar: DataFrame) -> DataFrame:
    """Per calendar day: number of business days up to it (``bd_number``) and
    the latest business day strictly before it (``previous_business_date``)."""
    w = Window.orderBy("cal_date")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    bd = F.col("is_business_day")
    return calendar.select(
        "cal_date", "is_business_day",
        F.sum(F.when(bd, 1).otherwise(0)).over(upto).alias("bd_number"),
        F.max(F.when(bd, F.col("cal_date"))).over(before).alias("previous_business_date"),
        F.max("cal_date").over(Window.partitionBy(F.trunc("cal_date", "month"))).alias("month_end"),
        F.max("cal_date").over(Window.partitionBy(F.trunc("cal_date", "quarter"))).alias("quarter_end"),
        F.max("cal_date").over(Window.partitionBy(F.trunc("cal_date", "year"))).alias("year_end"))


def date_calculations(dates: DataFrame, date_col: str, calendar: DataFrame,
                      offset: int = 1, lookback_days: int = HISTORY_LOOKBACK_DAYS) -> DataFrame:
    """For each business date in ``dates``: previous business day, the
    ``offset``-th business day counting back (1 = latest on or before), the
    history-pull start (``lookback_days`` business days), and the period
    starts and ends (ends are the last calendar day of the period)."""
    idx = F.broadcast(business_day_index(calendar))  # bounded by the calendar range
    bdays = F.broadcast(business_day_index(calendar).where("is_business_day")
                        .select(F.col("bd_number").alias("_n"), F.col("cal_date").alias("_bd")))
    d = dates.join(idx, F.col(date_col) == F.col("cal_date"), "left")
    d = (d.join(bdays.select(F.col("_n").alias("_n1"), F.col("_bd").alias("business_date_offset")),
                F.col("_n1") == F.col("bd_number") - offset + 1, "left")
         .join(bdays.select(F.col("_n").alias("_n2"), F.col("_bd").alias("history_start_date")),
               F.col("_n2") == F.greatest(F.col("bd_number") - lookback_days + 1, F.lit(1)), "left"))
    dc = F.col(date_col)
    return d.select(
        dc.alias("business_date"), "previous_business_date", "business_date_offset",
        "history_start_date",
        F.trunc(dc, "month").alias("month_start"), "month_end",
        F.trunc(dc, "quarter").alias("quarter_start"), "quarter_end",
        F.trunc(dc, "year").alias("year_start"), "year_end")
