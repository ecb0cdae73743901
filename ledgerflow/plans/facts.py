"""Facts (F-1 .. F-11) and the balance history dimension (D-9).

Join order is chosen for the large side: dimension contexts (account ->
customer, policy -> customer) are joined to each other first, so each fact
meets one context frame in one join on its own key. AQE picks broadcast
when a context is small at runtime and splits skewed join partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.money import MONEY_SUM, exact_avg, ratio, signed_amount
from ..operators.balances import daily_balances, daily_balances_by_month, window_balances
from ..operators.pit import point_in_time_join
from ..operators.scd2 import compress_runs, compress_runs_chunked, latest_per_key
from .shared import memo, shared
from ..sources.adapters import ORDERS_AS_OF, Tables
from . import dims


# ---- banking -----------------------------------------------------------------
@memo
def base_transactions(t: Tables) -> DataFrame:
    tx = t.stg_transactions()
    ttype = F.upper("transaction_type")
    return tx.select(
        "transaction_id", "account_id",
        F.col("transaction_timestamp").alias("transaction_ts"),
        F.col("transaction_timestamp").cast("date").alias("transaction_date"),
        "amount", "currency_code", ttype.alias("transaction_type"),
        signed_amount("amount", ttype, "DEBIT").alias("signed_amount"),
        "merchant_name", F.col("country_code").alias("transaction_country"))


@shared("fct_transactions")
def fct_transactions(t: Tables) -> DataFrame:
    ctx = dims.account_context(t)
    j = base_transactions(t).join(ctx, "account_id", "left")
    return j.select(
        surrogate_key("transaction_id").alias("transaction_sk"),
        "transaction_id", "account_id", "customer_id", "transaction_ts", "transaction_date",
        "amount", "currency_code", "transaction_type", "signed_amount", "merchant_name",
        "transaction_country", "product_code", "risk_rating", "customer_country")


@memo
def daily_net(t: Tables) -> DataFrame:
    """Net signed amount per account and day, summed straight from the orders:
    customers and countries have no part in it, so the first exchange comes
    after the partial sums. Accounts that do not exist have no day to enter."""
    ttype = F.upper("transaction_type")
    return (t.stg_transactions_lean()
            .select("account_id", F.col("transaction_timestamp").cast("date").alias("balance_date"),
                    signed_amount("amount", ttype, "DEBIT").alias("signed_amount"))
            .groupBy("account_id", "balance_date").agg(F.sum("signed_amount").alias("daily_net_amount")))


def balances_since(t: Tables, since: dt.date, as_of: dt.date = ORDERS_AS_OF) -> DataFrame:
    """The daily balances from ``since`` on, without the days before: amounts of the
    earlier days are summed per account, and only the window's days are generated."""
    acc = t.stg_accounts().select("account_id", "account_open_date", "opening_balance", "currency_code")
    return window_balances(acc, daily_net(t), since, as_of).withColumn(
        "account_balance_sk", surrogate_key("account_id", "balance_date"))


@shared("fct_account_daily_balance")
def fct_account_daily_balance(t: Tables, as_of: dt.date = ORDERS_AS_OF) -> DataFrame:
    acc = t.stg_accounts().select("account_id", "account_open_date", "opening_balance", "currency_code")
    bal = daily_balances(acc, daily_net(t), as_of)
    return bal.select(
        surrogate_key("account_id", "balance_date").alias("account_balance_sk"),
        "account_id", "balance_date", "currency_code", "daily_net_amount",
        "opening_balance", "closing_balance")


def fct_account_daily_balance_by_month(t: Tables, as_of: dt.date = ORDERS_AS_OF) -> DataFrame:
    """The same fact in two levels, month sums and days within each month: for accounts with very many days."""
    acc = t.stg_accounts().select("account_id", "account_open_date", "opening_balance", "currency_code")
    return daily_balances_by_month(acc, daily_net(t), as_of).withColumn("account_balance_sk", surrogate_key("account_id", "balance_date"))


def dim_account_balance_scd2_by_month(t: Tables) -> DataFrame:
    """The same periods, found per month and joined at its borders."""
    days = fct_account_daily_balance_by_month(t).select("account_id", "balance_date", "closing_balance")
    periods = compress_runs_chunked(days, ["account_id"], "balance_date", ["closing_balance"])
    return balance_periods_rows(periods, F.lit(str(ORDERS_AS_OF)).cast("date"))


def dim_account_balance_scd2(t: Tables, balances: DataFrame | None = None) -> DataFrame:
    """Periods of unchanged closing balance per account; key (account, start).

    Balances computed here run to the same day for every account, which is thus the last
    one; only of written or given balances is it looked up."""
    computed = balances is None and "fct_account_daily_balance" not in getattr(t, "materialized", {})
    bal = balances if balances is not None else fct_account_daily_balance(t)
    periods = compress_runs(bal.select("account_id", "balance_date", "closing_balance"),
                            ["account_id"], "balance_date", ["closing_balance"])
    last_day = F.lit(str(ORDERS_AS_OF)).cast("date") if computed else bal.agg(F.max("balance_date")).scalar()
    return balance_periods_rows(periods, last_day)


def balance_periods_increment(periods: DataFrame, window: DataFrame, window_start: dt.date) -> tuple[DataFrame, DataFrame]:
    """The balance history after a window of days was recomputed: (kept, rebuilt).

    ``window`` holds the balances from ``window_start`` on. Periods that ended
    before the day in front of it are kept as they are; an account's period that
    reaches this day goes on (same closing balance) or ends there, so only that row
    and the window's rows are compressed, not the account's whole history.
    """
    day = F.lit(str(window_start - dt.timedelta(days=1))).cast("date")
    kept = periods.where(F.col("effective_end_date") < day)
    reaching = periods.where((F.col("effective_end_date") >= day) & (F.col("effective_start_date") <= day))
    seed = reaching.select("account_id", day.alias("balance_date"), "closing_balance",
                           F.col("effective_start_date").alias("_since"))
    rows = seed.unionByName(window.select("account_id", "balance_date", "closing_balance", F.col("balance_date").alias("_since")))
    w = Window.partitionBy("account_id").orderBy("balance_date")
    runs = rows.withColumn("_run", F.sum(F.when(F.lag("closing_balance").over(w) == F.col("closing_balance"), 0).otherwise(1))
                           .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rebuilt = (runs.groupBy("account_id", "closing_balance", "_run")
               .agg(F.min("_since").alias("effective_start_date"), F.max("balance_date").alias("effective_end_date")).drop("_run"))
    return kept, rebuilt


def balance_periods_rows(periods: DataFrame, last_day) -> DataFrame:
    """The history's columns for (account, balance, start, end) periods."""
    return periods.select(
        surrogate_key("account_id", "effective_start_date").alias("account_balance_scd2_sk"),
        "account_id", "closing_balance", "effective_start_date", "effective_end_date",
        F.when(F.col("effective_end_date") == last_day, 1).otherwise(0).alias("is_current"))


def eom_balance(t: Tables) -> DataFrame:
    bal = fct_account_daily_balance(t)
    return (bal.groupBy("account_id", F.trunc("balance_date", "month").alias("month_start"))
            .agg(F.any_value("currency_code").alias("currency_code"),
                 F.max_by("closing_balance", "balance_date").alias("eom_closing_balance")))


@shared("exposure_context")
def exposure_context(t: Tables) -> DataFrame:
    """Per account with a current status: customer, risk rating and open credit limit."""
    limits = (t.stg_credit_limits().where(F.col("limit_end_date").isNull())
              .select("account_id", "credit_limit"))
    return (dims.current_account(t).select("account_id", "customer_id")
            .join(dims.current_customer(t).select("customer_id", "risk_rating"), "customer_id", "left")
            .join(limits, "account_id", "left"))


def fct_credit_exposure(t: Tables, balances: DataFrame | None = None, as_of: dt.date = ORDERS_AS_OF) -> DataFrame:
    """Available credit per account and day.

    Where the balances are computed here, the context joins the accounts (one row
    each) and the spine generated from them carries it along: no join and no
    broadcast ever has the account x day rows on a side. Written or given balances
    join the context on the account."""
    if balances is None and "fct_account_daily_balance" not in getattr(t, "materialized", {}):
        acc = (t.stg_accounts().select("account_id", "account_open_date", "opening_balance")
               .join(exposure_context(t), "account_id"))
        j = daily_balances(acc, daily_net(t), as_of, keep=("customer_id", "credit_limit", "risk_rating"))
    else:
        bal = balances if balances is not None else fct_account_daily_balance(t)
        j = bal.select("account_id", "balance_date", "closing_balance").join(exposure_context(t), "account_id")
    lim, cb = F.col("credit_limit"), F.col("closing_balance")
    return j.select(
        surrogate_key("account_id", "balance_date").alias("credit_exposure_sk"),
        "account_id", "customer_id", "balance_date", "closing_balance", "credit_limit",
        F.when(lim.isNotNull(), lim - cb).cast(MONEY_SUM).alias("available_credit"),
        F.when(lim.isNotNull() & (lim > 0), ratio(F.abs(cb), lim)).alias("utilisation_ratio"),
        "risk_rating",
        F.coalesce(cb < 0, F.lit(False)).alias("is_overdrawn"))


# ---- insurance -----------------------------------------------------------------
@memo
def premium_base(t: Tables) -> DataFrame:
    p = t.stg_premium_transactions()
    ptype = F.upper("premium_type")
    return p.select("premium_txn_id", "policy_id", F.col("posting_date").cast("date").alias("premium_date"),
                    ptype.alias("premium_type"), "amount", "currency_code")


@shared("premium_amounts")
def premium_amounts(t: Tables) -> DataFrame:
    """All premium rows with signed amounts, whatever their policy."""
    return premium_base(t).withColumn("premium_amount", signed_amount("amount", "premium_type", "REFUND"))


@memo
def premium_lines(t: Tables) -> DataFrame:
    """The premium fact's rows with the measures reports need: premiums of
    policies with a current version, signed, with the policy's product. The
    fact's customer context only adds columns, so reports skip it."""
    return premium_amounts(t).join(dims.current_policy(t).select("policy_id", "product_code"), "policy_id")


@shared("fct_premium")
def fct_premium(t: Tables) -> DataFrame:
    j = premium_base(t).join(dims.policy_context(t), "policy_id")
    return j.select(
        surrogate_key("premium_txn_id").alias("premium_sk"),
        "premium_txn_id", "policy_id", "policy_sk", "customer_id", "premium_date", "premium_type",
        signed_amount("amount", "premium_type", "REFUND").alias("premium_amount"),
        "currency_code", "product_code", "risk_rating")


@shared("fct_claims")
def fct_claims(t: Tables) -> DataFrame:
    """Claims with total paid, largest reserve and incurred = paid + reserve.

    Payments and reserves are aggregated per claim before the join, and both
    join the claims on claim_id; the policy context joins once on policy_id.
    """
    j = _claims_with_amounts(t).join(dims.policy_context(t), "policy_id")
    return j.select(
        surrogate_key("claim_id").alias("claim_sk"),
        "claim_id", "policy_id", "policy_sk", "customer_id", "claim_reported_date", "loss_date",
        "claim_type", "claim_status",
        F.col("paid_amt").alias("paid_amount"), F.col("res_amt").alias("reserve_amount"),
        (F.col("paid_amt") + F.col("res_amt")).cast(MONEY_SUM).alias("incurred_amount"),
        "product_code", "risk_rating")


@memo
def _claims_with_amounts(t: Tables) -> DataFrame:
    c = t.stg_claims().select(
        "claim_id", "policy_id", F.col("claim_reported_date").cast("date").alias("claim_reported_date"),
        F.col("loss_date").cast("date").alias("loss_date"), "claim_type", "claim_status")
    paid = t.stg_claim_payments().groupBy("claim_id").agg(F.sum("payment_amount").alias("total_paid_amount"))
    res = t.stg_claim_reserves().groupBy("claim_id").agg(F.max("reserve_amount").alias("current_reserve_amount"))
    zero = F.lit(0).cast(MONEY_SUM)
    paid_amt = F.coalesce(F.col("total_paid_amount").cast(MONEY_SUM), zero)
    res_amt = F.coalesce(F.col("current_reserve_amount").cast(MONEY_SUM), zero)
    return (c.join(paid, "claim_id", "left").join(res, "claim_id", "left")
            .withColumn("paid_amt", paid_amt).withColumn("res_amt", res_amt))


@shared("claim_amounts")
def claim_amounts(t: Tables) -> DataFrame:
    """All claims with paid and incurred amounts, whatever their policy."""
    return _claims_with_amounts(t).select(
        "claim_id", "policy_id", "claim_reported_date", F.col("paid_amt").alias("paid_amount"),
        (F.col("paid_amt") + F.col("res_amt")).cast(MONEY_SUM).alias("incurred_amount"))


@memo
def claim_lines(t: Tables) -> DataFrame:
    """The claims fact's rows (claims of policies with a current version) with
    paid and incurred amounts and the policy's product, without the customer
    context the reports do not use."""
    return claim_amounts(t).join(dims.current_policy(t).select("policy_id", "product_code"), "policy_id")


@memo
def reserve_snapshots(t: Tables) -> DataFrame:
    return t.stg_claim_reserves_snapshots().select(
        "claim_id", F.col("reserve_snapshot_date").cast("date").alias("snapshot_date"),
        "reserve_type", "reserve_amount")


@memo
def claim_policy(t: Tables) -> DataFrame:
    """(claim_id, policy_id) of the claims fact: claims whose policy has a
    current version. The fact's other joins are left joins on unique keys and
    never change its rows, so they are not evaluated here."""
    cur = dims.current_policy(t).select("policy_id")
    return t.stg_claims().select("claim_id", "policy_id").join(cur, "policy_id", "left_semi")


@shared("fct_claim_reserve_snapshots")
def fct_claim_reserve_snapshots(t: Tables) -> DataFrame:
    """Reserve snapshots with the claim's policy and the policy's current attributes.

    The policy joins the claims, the smaller side, so the snapshots are exchanged
    once, by claim, and what groups them by claim and day needs no other exchange."""
    cur = dims.current_policy(t).select("policy_id", "product_code", "customer_id")
    claims = t.stg_claims().select("claim_id", "policy_id").join(cur, "policy_id")
    j = reserve_snapshots(t).join(claims, "claim_id")
    return j.select(
        surrogate_key("claim_id", "snapshot_date", "reserve_type").alias("claim_reserve_sk"),
        "claim_id", "policy_id", "product_code", "customer_id", "snapshot_date",
        "reserve_type", "reserve_amount")


def fct_claim_reserve_snapshots_pit(t: Tables) -> DataFrame:
    """Point-in-time form: the policy version valid on the snapshot date."""
    pol = dims.dim_policy(t).select("policy_id", "policy_sk", "product_code", "customer_id",
                                     "effective_from", "effective_to")
    r = reserve_snapshots(t).join(claim_policy(t), "claim_id")
    j = point_in_time_join(r, pol, ["policy_id"], "snapshot_date", "effective_from", "effective_to",
                           how="inner")
    return j.select(
        surrogate_key("claim_id", "snapshot_date", "reserve_type").alias("claim_reserve_sk"),
        "claim_id", "policy_id", "policy_sk", "product_code", "customer_id", "snapshot_date",
        "reserve_type", "reserve_amount")


@memo
def entity_ratings(t: Tables) -> DataFrame:
    """Current rating per (entity_id, entity_type): customers from the customer
    history, accounts and policies from their snapshots. One row per entity."""
    cust = dims.current_customer(t).select(
        F.col("customer_id").alias("entity_id"), F.lit("CUSTOMER").alias("entity_type"),
        F.col("risk_rating").alias("historic_risk_rating"))
    acc = (t.account_snapshot().where(F.col("dbt_valid_to").isNull())
           .select(F.col("account_id").alias("entity_id"), F.lit("ACCOUNT").alias("entity_type"),
                   F.col("account_risk_rating").alias("historic_risk_rating")))
    pol = (t.policy_snapshot().where(F.col("dbt_valid_to").isNull())
           .select(F.col("policy_id").alias("entity_id"), F.lit("POLICY").alias("entity_type"),
                   F.col("policy_risk_rating").alias("historic_risk_rating")))
    return cust.unionByName(acc).unionByName(pol)


@memo
def daily_risk_scores(t: Tables) -> DataFrame:
    """The latest score of each (entity, type, day): the rows of the risk fact
    (its ratings join is a left join on a unique key and adds columns only)."""
    s = t.stg_risk_scores().select(
        "entity_id", "entity_type", "risk_score", F.upper("risk_category").alias("risk_category"),
        F.col("score_date").cast("date").alias("score_day"), F.col("score_date").alias("score_ts"), "score_id")
    return latest_per_key(s, ["entity_id", "entity_type", "score_day"], "score_ts", "score_id")


@shared("fct_risk_score")
def fct_risk_score(t: Tables) -> DataFrame:
    """One score per (entity, type, day): the latest of the day (merge-key
    semantics), with the entity's current rating."""
    j = daily_risk_scores(t).join(entity_ratings(t), ["entity_id", "entity_type"], "left")
    return j.select(
        surrogate_key("entity_id", "entity_type", "score_day").alias("risk_score_sk"),
        "entity_id", "entity_type", "risk_score", "risk_category", "historic_risk_rating",
        F.col("score_day").alias("score_date"))


def _month(c: str):
    return F.trunc(F.col(c), "month")


def fct_loss_ratio(t: Tables) -> DataFrame:
    """Per current policy and claim month: incurred, premium in the same month,
    ratio (null when premium is 0). Policies without claims keep one row with
    a null month."""
    mc = (claim_lines(t).groupBy("policy_id", _month("claim_reported_date").alias("claim_month"))
          .agg(F.sum("incurred_amount").cast(MONEY_SUM).alias("mc_incurred")))
    mp = (premium_lines(t).groupBy("policy_id", _month("premium_date").alias("premium_month"))
          .agg(F.sum("premium_amount").cast(MONEY_SUM).alias("mp_premium")))
    pc = dims.current_policy(t).select("policy_id", "product_code")
    j = (pc.join(mc, "policy_id", "left")
         .join(mp, (pc["policy_id"] == mp["policy_id"]) & (F.col("claim_month") == F.col("premium_month")), "left")
         .drop(mp["policy_id"]))
    zero = F.lit(0).cast(MONEY_SUM)
    prem = F.coalesce(F.col("mp_premium"), zero)
    return j.select(
        surrogate_key("policy_id", "claim_month").alias("loss_ratio_sk"),
        "policy_id", "product_code", F.col("claim_month").alias("period_month"),
        F.coalesce(F.col("mc_incurred"), zero).alias("total_incurred"),
        prem.alias("total_premium"),
        F.when(prem != 0, ratio("mc_incurred", "mp_premium")).alias("loss_ratio"))


def fct_product_performance(t: Tables) -> DataFrame:
    """Per product and month: premium, incurred, ratio and average policy risk;
    the full outer join keeps claim-only months with their product and month."""
    mp = (premium_lines(t).groupBy("product_code", _month("premium_date").alias("month"))
          .agg(F.sum("premium_amount").cast(MONEY_SUM).alias("mp_premium")))
    mc = (claim_lines(t).groupBy("product_code", _month("claim_reported_date").alias("month"))
          .agg(F.sum("incurred_amount").cast(MONEY_SUM).alias("mc_incurred")))
    pol = dims.current_policy(t).select(F.col("policy_id").alias("entity_id"), "product_code")
    risk = (daily_risk_scores(t).where(F.col("entity_type") == "POLICY")
            .join(pol, "entity_id")
            .groupBy("product_code", _month("score_day").alias("month"))
            .agg(exact_avg("risk_score").alias("avg_risk_score")))
    pm = mp.join(mc, ["product_code", "month"], "full_outer")
    zero = F.lit(0).cast(MONEY_SUM)
    prem = F.coalesce(F.col("mp_premium"), zero)
    j = pm.join(risk, ["product_code", "month"], "left")
    return j.select(
        "product_code", "month", prem.alias("total_premium"),
        F.coalesce(F.col("mc_incurred"), zero).alias("total_incurred"),
        F.when(prem != 0, ratio("mc_incurred", "mp_premium")).alias("loss_ratio"),
        "avg_risk_score")


def fct_suspicious_activity(t: Tables) -> DataFrame:
    """AML rules, first match names the rule: amount at or above the large
    limit (HIGH), high-risk country (HIGH), per-account-day count at or above
    the velocity limit (MEDIUM).

    Velocity is counted on the transactions alone, before any context is joined;
    the account's customer must have a current row, which the context tells."""
    base = base_transactions(t)
    seed = t.seed_aml_thresholds()

    def limit(rule: str):
        return seed.agg(F.max(F.when(F.col("rule_name") == rule, F.col("threshold_value")))).scalar()

    country = F.broadcast(t.seed_country_risk())  # one row per country: bounded domain
    per_day = (t.stg_transactions_lean()
               .groupBy("account_id", F.col("transaction_timestamp").cast("date").alias("transaction_date"))
               .agg(F.count(F.lit(1)).alias("txn_count")).where(F.col("txn_count") >= limit("HIGH_VELOCITY_TXN"))
               .select("account_id", "transaction_date", F.lit(True).alias("fast")))
    amount = F.abs("amount")
    rules = (base.join(country, F.col("transaction_country") == F.col("country_code"), "left")
             .join(per_day, ["account_id", "transaction_date"], "left")
             .withColumn("rule_triggered",
                         F.when(amount >= limit("LARGE_TRANSACTION"), "LARGE_TRANSACTION")
                         .when(F.col("risk_level") == "HIGH", "HIGH_RISK_COUNTRY").when(F.col("fast"), "HIGH_VELOCITY"))
             .where(F.col("rule_triggered").isNotNull()))
    owners = dims.current_account(t).select("account_id", "customer_id").join(
        dims.current_customer(t).select("customer_id"), "customer_id")
    return (rules.join(owners, "account_id")
            .withColumn("transaction_sk", surrogate_key("transaction_id"))
            .select(surrogate_key("transaction_sk", "rule_triggered").alias("suspicious_activity_sk"),
                    "transaction_id", "transaction_sk", "account_id", "customer_id", "rule_triggered",
                    F.when(F.col("rule_triggered") == "HIGH_VELOCITY", "MEDIUM").otherwise("HIGH").alias("alert_severity"),
                    "transaction_ts", amount.alias("amount"), "currency_code"))
