"""Insolvency and bankruptcy periods (F-8, R-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.islands import close_last_period, day_periods
from ..sources.adapters import INSOLVENCY_CODES, Tables


def fct_insolvency(t: Tables) -> DataFrame:
    """Events with a known code -> islands of days per account -> one period per
    (account, customer, code, island); the account's latest period is open."""
    codes = F.broadcast(t.seed_insolvency_codes())  # fixed 5-row seed
    ev = (t.insolvency_events().join(codes, "insolvency_code", "left_semi")
          .select("account_id", "customer_id", "insolvency_code",
                  F.col("event_date").cast("date").alias("event_date")))
    periods = day_periods(ev, ["account_id"], ["account_id", "customer_id", "insolvency_code"],
                          "event_date", "insolvency_group",
                          "insolvency_start_date", "insolvency_end_date")
    final = close_last_period(periods, ["account_id"], "insolvency_end_date", "is_currently_insolvent")
    return final.select(
        surrogate_key("account_id", "customer_id", "insolvency_code", "insolvency_group").alias("insolvency_sk"),
        "account_id", "customer_id", "insolvency_code",
        "insolvency_start_date", "insolvency_end_date", "is_currently_insolvent")


def bankruptcy(t: Tables) -> DataFrame:
    """Same islands, numbered per (account, customer), codes given as a literal list."""
    ev = (t.insolvency_events().where(F.col("insolvency_code").isin(*INSOLVENCY_CODES))
          .select("account_id", "customer_id", "insolvency_code",
                  F.col("event_date").cast("date").alias("event_date")))
    keys = ["account_id", "customer_id"]
    periods = day_periods(ev, keys, keys + ["insolvency_code"], "event_date", "bankruptcy_group",
                          "bankruptcy_start_date", "bankruptcy_end_date")
    final = close_last_period(periods, keys, "bankruptcy_end_date", "is_currently_bankrupt")
    return final.select(
        surrogate_key("account_id", "customer_id", "insolvency_code", "bankruptcy_group").alias("bankruptcy_id"),
        "account_id", "customer_id", "insolvency_code",
        "bankruptcy_start_date", "bankruptcy_end_date", "is_currently_bankrupt")
