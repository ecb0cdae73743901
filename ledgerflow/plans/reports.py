"""Regulatory reports and sample queries (R-1 .. R-7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.money import MONEY_SUM, exact_avg, parts_total, sum_parts
from ..operators.pit import point_in_time_join
from ..sources.adapters import ORDERS_AS_OF, Tables
from . import dims, facts
from .shared import shared


def _month(c: str):
    return F.trunc(F.col(c), "month")


def policy_risk_by_month(t: Tables) -> DataFrame:
    """Average risk score per policy and month (scores of entity_type POLICY)."""
    return (facts.daily_risk_scores(t).where(F.col("entity_type") == "POLICY")
            .groupBy(F.col("entity_id").alias("policy_id"), _month("score_day").alias("period"))
            .agg(exact_avg("risk_score").alias("avg_risk_score")))


def rpt_fca_returns(t: Tables) -> DataFrame:
    """Per current policy and premium month: total and earned premium, claims
    incurred in the month, average risk. Each side is aggregated before the
    join, so premiums and claims of one month never multiply each other."""
    prem = (facts.premium_lines(t).groupBy("policy_id", _month("premium_date").alias("period"))
            .agg(F.sum("premium_amount").cast(MONEY_SUM).alias("total_premium"),
                 F.sum(F.when(F.col("premium_type") == "EARNED", F.col("premium_amount"))
                       .otherwise(F.lit(0))).cast(MONEY_SUM).alias("earned_premium")))
    clm = (facts.claim_lines(t).groupBy("policy_id", _month("claim_reported_date").alias("period"))
           .agg(F.sum("incurred_amount").cast(MONEY_SUM).alias("_claims")))
    mf = (prem.join(clm, ["policy_id", "period"], "left")
          .withColumn("total_claims", F.coalesce(F.col("_claims"), F.lit(0).cast(MONEY_SUM))))
    return _fca_final(t, mf)


def rpt_fca_returns_literal(t: Tables) -> DataFrame:
    """The report as written: premium rows left-joined to the claim rows of the
    same policy and month before summing, so each premium counts once per
    matching claim (at least once) and each claim once per premium row.

    The same totals come from per-side sums and row counts, without forming
    the premium x claim pairs (which grow quadratically on a busy policy)."""
    prem = (facts.premium_lines(t).groupBy("policy_id", _month("premium_date").alias("period"))
            .agg(F.sum("premium_amount").alias("_p"),
                 F.sum(F.when(F.col("premium_type") == "EARNED", F.col("premium_amount"))
                       .otherwise(F.lit(0))).alias("_e"),
                 F.count(F.lit(1)).alias("_np")))
    clm = (facts.claim_lines(t).groupBy("policy_id", _month("claim_reported_date").alias("period"))
           .agg(F.sum(F.coalesce("incurred_amount", F.lit(0))).alias("_c"), F.count(F.lit(1)).alias("_nc")))
    j = prem.join(clm, ["policy_id", "period"], "left")
    rep = F.greatest(F.coalesce(F.col("_nc"), F.lit(0)), F.lit(1))
    mf = j.select(
        "policy_id", "period",
        (F.col("_p") * rep).cast(MONEY_SUM).alias("total_premium"),
        (F.col("_e") * rep).cast(MONEY_SUM).alias("earned_premium"),
        F.coalesce(F.col("_c") * F.col("_np"), F.lit(0)).cast(MONEY_SUM).alias("total_claims"))
    return _fca_final(t, mf)


def _fca_final(t: Tables, mf: DataFrame) -> DataFrame:
    pa = dims.current_policy(t).select("policy_id", "product_code")
    j = mf.join(pa, "policy_id").join(policy_risk_by_month(t), ["policy_id", "period"], "left")
    return j.select(
        surrogate_key("policy_id", "period").alias("fca_return_sk"),
        "policy_id", "product_code", F.col("period").alias("reporting_period"),
        "total_premium", "earned_premium", "total_claims", "avg_risk_score")


@shared("ifrs_contract_metrics")
def ifrs_contract_metrics(t: Tables) -> DataFrame:
    return t.stg_ifrs_contract_metrics()


def _ifrs(t: Tables, reserve_summary: DataFrame) -> DataFrame:
    """Summaries of all rows by policy and month; only policies with a current version
    stay, and these join once, at the end. Sums of MONEY stay in their two parts until then."""
    ps = facts.premium_amounts(t).groupBy("policy_id", _month("premium_date").alias("reporting_period")).agg(
        *sum_parts(F.when(F.col("premium_type") == "WRITTEN", F.col("premium_amount")), "written"),
        *sum_parts(F.when(F.col("premium_type") == "EARNED", F.col("premium_amount")), "earned"))
    cs = facts.claim_amounts(t).groupBy("policy_id", _month("claim_reported_date").alias("reporting_period")).agg(
        F.sum(F.coalesce("paid_amount", F.lit(0))).cast(MONEY_SUM).alias("total_paid"),
        F.sum(F.coalesce("incurred_amount", F.lit(0))).cast(MONEY_SUM).alias("total_incurred"))
    icm = ifrs_contract_metrics(t)
    pi = dims.current_policy(t).select("policy_id", "product_code")
    keys = ["policy_id", "reporting_period"]
    # the period-keyed summaries are each aggregated on (policy, month), so
    # they join without a further exchange; the policy list joins last
    periods = (ps.join(cs, keys, "left").join(reserve_summary, keys, "left").join(icm, keys, "left"))
    j = pi.join(periods, "policy_id", "left")
    zero = F.lit(0).cast(MONEY_SUM)
    return j.select(
        surrogate_key("policy_id", "reporting_period").alias("ifrs_balance_sk"),
        "policy_id", "product_code", "reporting_period",
        F.coalesce(parts_total("written"), zero).alias("written_premium"),
        F.coalesce(parts_total("earned"), zero).alias("earned_premium"),
        F.coalesce("total_paid", zero).alias("claims_paid"),
        F.coalesce("total_incurred", zero).alias("claims_incurred"),
        F.coalesce(parts_total("reserves"), zero).alias("claim_reserves"),
        "csm", "risk_adjustment")


@shared("reserves_with_policy")
def reserves_with_policy(t: Tables) -> DataFrame:
    """Reserve snapshots with their claim's policy: exchanged by claim, once. A partition's
    claims, several times fewer than its snapshots, are hashed, so the snapshots are not sorted."""
    claims = t.stg_claims().select("claim_id", "policy_id").hint("shuffle_hash")
    return facts.reserve_snapshots(t).join(claims, "claim_id")


def rpt_ifrs_balances(t: Tables) -> DataFrame:
    """IFRS balances; reserves are the latest snapshot per claim, type and
    month, summed per policy and month."""
    latest = (reserves_with_policy(t)
              .groupBy("claim_id", "policy_id", "reserve_type", _month("snapshot_date").alias("reporting_period"))
              .agg(F.max_by("reserve_amount", "snapshot_date").alias("latest_reserve")))
    rs = (latest.groupBy("policy_id", "reporting_period")
          .agg(*sum_parts("latest_reserve", "reserves")))
    return _ifrs(t, rs)


def rpt_ifrs_balances_literal(t: Tables) -> DataFrame:
    """As written: every daily reserve snapshot of the month is summed."""
    rs = (reserves_with_policy(t).groupBy("policy_id", _month("snapshot_date").alias("reporting_period"))
          .agg(*sum_parts("reserve_amount", "reserves")))
    return _ifrs(t, rs)


def pra_exposures(exposures: DataFrame) -> DataFrame:
    agg = (exposures.groupBy(_month("exposure_date").alias("reporting_period"), "risk_type", "asset_class")
           .agg(F.sum("exposure_amount").cast(MONEY_SUM).alias("total_exposure")))
    return agg.select(
        surrogate_key("reporting_period", "risk_type", "asset_class").alias("pra_exposure_sk"),
        "reporting_period", "risk_type", "asset_class", "total_exposure")


def rpt_pra_exposures(t: Tables) -> DataFrame:
    return pra_exposures(t.exposures())


SPENDING_KEYS = ["customer_id", "transaction_date", "store_area", "payment_bank", "payment_card_type"]


def spending(src: DataFrame, *more: Column) -> DataFrame:
    """The report's rows of ``src``, with ``more`` aggregates of each group."""
    return src.groupBy(*SPENDING_KEYS).agg(
        F.countDistinct("transaction_id").alias("transactions_count"),
        F.sum("transaction_amount").cast(MONEY_SUM).alias("total_spent"),
        exact_avg("transaction_amount").alias("avg_transaction_value"),
        F.sum("loyalty_points_earned").alias("total_loyalty_points"),
        F.max("transaction_timestamp").alias("last_transaction_time"), *more)


def customer_spending_analysis(t: Tables) -> DataFrame:
    return spending(t.retail_daily_transactions())


def customer_spending_changes(t: Tables, stored: DataFrame, since: dt.datetime) -> DataFrame:
    """The groups that rows updated at or after ``since`` touch, each from all its rows."""
    src = t.retail_daily_transactions()
    touched = src.where(F.col("last_updated_at") >= F.lit(str(since)).cast("timestamp_ntz")).select(*SPENDING_KEYS).distinct()
    return spending(src.join(touched, SPENDING_KEYS, "left_semi"))


def reserve_trend_90d(t: Tables, as_of: dt.date = ORDERS_AS_OF,
                      calendar: DataFrame | None = None) -> DataFrame:
    """Reserve total by product and snapshot day over the last 90 days; the
    policy version is the one valid on the snapshot date."""
    from ..operators.calendar import dim_calendar
    start = as_of - dt.timedelta(days=90)
    cal = calendar if calendar is not None else dim_calendar(t.spark, start, as_of + dt.timedelta(days=1))
    f = facts.fct_claim_reserve_snapshots(t).where(
        F.col("snapshot_date") >= F.lit(str(start)).cast("date"))
    pol = dims.dim_policy(t).select("policy_id", F.col("product_code").alias("pit_product_code"),
                                     "effective_from", "effective_to")
    j = point_in_time_join(f, pol, ["policy_id"], "snapshot_date", "effective_from", "effective_to",
                           how="inner")
    c = F.broadcast(cal.select("date_day"))  # bounded: one row per calendar day
    j = j.join(c, F.col("snapshot_date") == F.col("date_day"))
    return (j.where(F.col("date_day") >= F.lit(str(start)).cast("date"))
            .groupBy(F.col("pit_product_code").alias("product_code"), F.col("date_day").alias("snapshot_date"))
            .agg(F.sum("reserve_amount").cast(MONEY_SUM).alias("total_reserve"))
            .orderBy("snapshot_date", "product_code"))  # one row per product and day: small
