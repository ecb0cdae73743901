"""Calendar jobs over the span of the driver's data (K1-K6, IN9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import calendar as cal
from ..sources.adapters import Tables
from .registry import job


def data_date_bounds(t: Tables) -> DataFrame:
    """One row: first day of the earliest year and the day after the end of the
    latest year in which any order, shipment or event falls."""
    lo_hi = [
        t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")),
        t.lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")),
        t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")),
    ]
    u = lo_hi[0].unionByName(lo_hi[1]).unionByName(lo_hi[2])
    return u.agg(F.trunc(F.min("lo").cast("date"), "year").alias("start"),
                 F.add_months(F.trunc(F.max("hi").cast("date"), "year"), 12).alias("end"))


def data_calendar(t: Tables) -> DataFrame:
    return cal.calendar_from_spine(cal.date_spine_from(data_date_bounds(t)), t.bank_holidays())


@job("date_spine")
def date_spine(t: Tables) -> DataFrame:
    return cal.date_spine_from(data_date_bounds(t))


@job("dim_calendar")
def dim_calendar(t: Tables) -> DataFrame:
    return data_calendar(t)


@job("business_date")
def business_date(t: Tables) -> DataFrame:
    """Business date of every event at a 04:00 cutoff."""
    return t.events.select("event_id", "ts", cal.business_date("ts", "UTC", 4).alias("business_date"))


@job("date_calculations")
def date_calculations(t: Tables) -> DataFrame:
    """Business-date arithmetic for every distinct order date."""
    dates = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return cal.date_calculations(dates, "d", data_calendar(t), offset=2)


@job("history_date_pull")
def history_date_pull(t: Tables) -> DataFrame:
    """Start of the five-business-day lookback for every distinct event day."""
    dates = t.events.select(F.col("ts").cast("date").alias("d")).distinct()
    return (cal.date_calculations(dates, "d", data_calendar(t))
            .select("business_date", "history_start_date"))


