"""Data-quality and audit jobs over the pipeline's outputs (Q1-Q17).

Summary checks return one row per declared test with its failure count
(0 = pass); checks over one model share one aggregate pass. Row-level checks
(overlaps, point-in-time matches, payment totals) return the failing rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import audit
from ..operators import quality as q
from ..operators.pit import pit_match_counts
from ..sources.adapters import ORDERS_AS_OF, Tables
from . import calendar_jobs, dims, facts, reports
from .registry import job

Model = Callable[[Tables], DataFrame]

# The tests declared on models and sources.
MODELS: dict[str, Model] = {
    "fct_claim_reserve_snapshots": facts.fct_claim_reserve_snapshots,
    "fct_account_daily_balance": facts.fct_account_daily_balance,
    "dim_policy": dims.dim_policy,
    "dim_claim": dims.dim_claim,
    "dim_product": dims.dim_product,
    "dim_customer": dims.dim_customer,
    "dim_reserve_type": dims.dim_reserve_type,
    "dim_calendar": calendar_jobs.data_calendar,
    "stg_claim_reserves_snapshots": lambda t: t.stg_claim_reserves_snapshots(),
    "stg_claims": lambda t: t.stg_claims(),
    "stg_policies": lambda t: t.stg_policies(),
    "stg_products": lambda t: t.stg_products(),
    "stg_customers": lambda t: t.stg_customers(),
    "stg_accounts": lambda t: t.stg_accounts(),
    "stg_transactions": lambda t: t.stg_transactions(),
}
NOT_NULL = {
    "fct_claim_reserve_snapshots": ["claim_reserve_sk", "claim_id", "snapshot_date", "reserve_type",
                                    "reserve_amount"],
    "fct_account_daily_balance": ["account_balance_sk", "account_id", "balance_date", "currency_code",
                                  "opening_balance", "closing_balance"],
    "dim_policy": ["policy_sk", "policy_id", "effective_from"],
    "dim_claim": ["claim_id"],
    "dim_product": ["product_code"],
    "dim_customer": ["customer_id"],
    "dim_reserve_type": ["reserve_type_sk", "reserve_type"],
    "dim_calendar": ["date_day"],
    "stg_claim_reserves_snapshots": ["claim_id", "reserve_snapshot_date", "reserve_type", "reserve_amount"],
    "stg_claims": ["claim_id", "policy_id"],
    "stg_policies": ["policy_id"],
    "stg_products": ["product_code"],
    "stg_customers": ["customer_id"],
    "stg_accounts": ["account_id"],
    "stg_transactions": ["account_id", "transaction_timestamp"],
}
UNIQUE = [
    ("fct_claim_reserve_snapshots", ["claim_reserve_sk"]),
    ("fct_account_daily_balance", ["account_balance_sk"]),
    ("dim_policy", ["policy_sk"]),
    ("dim_claim", ["claim_id"]),
    ("dim_product", ["product_code"]),
    ("dim_customer", ["customer_id"]),
    ("dim_reserve_type", ["reserve_type_sk"]),
    ("dim_reserve_type", ["reserve_type"]),
    ("dim_calendar", ["date_day"]),
    ("stg_claims", ["claim_id"]),
    ("stg_products", ["product_code"]),
    ("stg_customers", ["customer_id"]),
    ("stg_accounts", ["account_id"]),
]
# The columns that a surrogate key is the hash of: it repeats where they do.
HASHED = {
    ("fct_claim_reserve_snapshots", "claim_reserve_sk"): ["claim_id", "snapshot_date", "reserve_type"],
    ("fct_account_daily_balance", "account_balance_sk"): ["account_id", "balance_date"],
    ("dim_policy", "policy_sk"): ["policy_id", "effective_from"],
    ("dim_reserve_type", "reserve_type_sk"): ["reserve_type"],
}
UNIQUE_COMBO = [
    ("fct_claim_reserve_snapshots", ["claim_id", "snapshot_date", "reserve_type"]),
    ("dim_policy", ["policy_id", "effective_from"]),
    ("fct_account_daily_balance", ["account_id", "balance_date"]),
]
RELATIONSHIPS = [
    ("fct_claim_reserve_snapshots", "claim_id", "dim_claim", "claim_id"),
    ("fct_claim_reserve_snapshots", "policy_id", "dim_policy", "policy_id"),
    ("fct_claim_reserve_snapshots", "snapshot_date", "dim_calendar", "date_day"),
    ("fct_claim_reserve_snapshots", "reserve_type", "dim_reserve_type", "reserve_type"),
    ("fct_account_daily_balance", "balance_date", "dim_calendar", "date_day"),
]
ACCEPTED = [
    ("dim_policy", "is_current_record", [True, False]),
    ("dim_claim", "claim_status", ["OPEN", "CLOSED", "REOPENED"]),
    ("dim_customer", "customer_type", ["PERSON", "ORGANIZATION"]),
    ("dim_calendar", "is_weekend", [True, False]),
]
EXPRESSIONS = [
    ("fct_claim_reserve_snapshots", "reserve_amount >= 0"),
    ("dim_policy", "coalesce(effective_to, date '2999-12-31') > effective_from"),
]
# Freshness: (source, adapter, column, warn hours, error hours). The test tables carry no
# load times: the newest business date or change time of each source stands for it.
FRESHNESS = [
    ("claim_reserves_snapshots", "stg_claim_reserves_snapshots", "reserve_snapshot_date", 2, 6),
    ("claims", "stg_claims", "claim_reported_date", 6, 12),
    ("policies", "stg_policies", "policy_start_date", 6, 12),
    ("accounts", "stg_accounts", "account_open_date", 24, 48),
    ("transactions", "stg_transactions", "transaction_timestamp", 2, 6),
    ("products", "product_prices", "last_updated_at", 24, 48),
    ("customers", "crm_customer_changes", "last_updated_at", 24, 48),
    ("calendar", "bank_holidays", "holiday_date", 168, 720),
]


def _union(frames: Sequence[DataFrame]) -> DataFrame | None:
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_metrics(model: str) -> dict[tuple[str, str], Column]:
    """(check, what) -> failing rows of the model, as aggregates of its rows: what can be
    counted while the model is written (Q1, Q6, Q7)."""
    out = {("dq_not_null", c): F.count_if(F.col(c).isNull()) for c in NOT_NULL.get(model, [])}
    out |= {("dq_accepted_values", c): F.count_if(~F.col(c).isin(*vals)) for m, c, vals in ACCEPTED if m == model}
    return out | {("dq_expression", e): F.count_if(~F.expr(e)) for m, e in EXPRESSIONS if m == model}


@job("dq_not_null")
def dq_not_null(t: Tables, without: Collection[str] = ()) -> DataFrame:
    """Null count per declared not-null column; one aggregate pass per model (not of models in ``without``)."""
    parts = []
    for model, cols in NOT_NULL.items():
        if model in without:
            continue
        nc = q.null_counts(MODELS[model](t).select(*cols), cols)
        parts.append(nc.select(F.lit(model).alias("model_name"), "column_name",
                               F.col("null_count").alias("failures")))
    return _union(parts)


def _dup_summary(rows: Sequence[tuple[str, list[str]]], t: Tables) -> DataFrame:
    parts = []
    for model, cols in rows:
        keys = HASHED.get((model, cols[0]), cols) if len(cols) == 1 else cols
        d = q.unique(MODELS[model](t).select(*keys), keys)
        parts.append(d.agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit(model).alias("model_name"), F.lit(",".join(cols)).alias("column_name"),
                             "failures"))
    return _union(parts)


@job("dq_unique")
def dq_unique(t: Tables) -> DataFrame:
    """Number of key values occurring more than once, per declared unique column.

    A surrogate key is tested by the columns it hashes: no hash is computed or
    exchanged, and a model already dealt by one of them is not exchanged again."""
    return _dup_summary(UNIQUE, t)


@job("dq_unique_combo")
def dq_unique_combo(t: Tables) -> DataFrame:
    return _dup_summary(UNIQUE_COMBO, t)


def _labelled(failures: DataFrame, **labels: str) -> DataFrame:
    return failures.select(*[F.lit(v).alias(k) for k, v in labels.items()], "failures")


def _count(df: DataFrame, **labels: str) -> DataFrame:
    return _labelled(df.agg(F.count(F.lit(1)).alias("failures")), **labels)


@job("dq_relationships")
def dq_relationships(t: Tables) -> DataFrame:
    parts = [
        _labelled(q.orphan_count(MODELS[m](t).select(c), c, MODELS[to](t), f),
                  model_name=m, column_name=c, to_model=to, field=f)
        for m, c, to, f in RELATIONSHIPS]
    return _union(parts)


@job("dq_relationships_where")
def dq_relationships_where(t: Tables) -> DataFrame:
    fails = q.orphan_count(facts.fct_claim_reserve_snapshots(t).select("reserve_type").where("1=1"), "reserve_type",
                           dims.dim_reserve_type(t).where("is_active = 1"), "reserve_type")
    return _labelled(fails, model_name="fct_claim_reserve_snapshots", column_name="reserve_type",
                     to_model="dim_reserve_type", field="reserve_type")


@job("dq_accepted_values")
def dq_accepted_values(t: Tables, without: Collection[str] = ()) -> DataFrame:
    return _union([_count(q.accepted_values(MODELS[m](t).select(c), c, vals), model_name=m, column_name=c)
                   for m, c, vals in ACCEPTED if m not in without])


@job("dq_expression")
def dq_expression(t: Tables, without: Collection[str] = ()) -> DataFrame:
    return _union([_count(q.expression_is_true(MODELS[m](t), e), model_name=m, expression=e)
                   for m, e in EXPRESSIONS if m not in without])


@job("dq_no_overlap")
def dq_no_overlap(t: Tables) -> DataFrame:
    """dim_policy versions overlapping the next version of the same policy."""
    p = dims.dim_policy(t).select("policy_sk", "policy_id", "effective_from", "effective_to")
    return q.no_overlapping_ranges(p, "policy_id", "effective_from",
                                   "coalesce(effective_to, date '2999-12-31')")


@job("dq_policy_pit")
def dq_policy_pit(t: Tables) -> DataFrame:
    """Reserve-snapshot facts (claim, policy, day) that do not match exactly one
    policy version on their snapshot date; unmatched rows count 0."""
    f = facts.fct_claim_reserve_snapshots(t).select("claim_id", "policy_id", "snapshot_date").distinct()
    p = dims.dim_policy(t)
    m = pit_match_counts(f, p, ["claim_id", "policy_id", "snapshot_date"], ["policy_id"],
                         "snapshot_date", "effective_from", "effective_to")
    return m.where(F.col("match_cnt") != 1)


@job("dq_payment_total")
def dq_payment_total(t: Tables) -> DataFrame:
    """Orders whose payments sum below zero."""
    return (t.stg_payments().groupBy("order_id").agg(F.sum("amount").cast("decimal(38,2)").alias("total_amt"))
            .where(F.col("total_amt") < 0))


@job("dq_freshness")
def dq_freshness(t: Tables, as_of: dt.date = ORDERS_AS_OF) -> DataFrame:
    """Age in whole hours of each source's latest load at ``as_of`` and its status."""
    parts = []
    for source, adapter, col, warn, err in FRESHNESS:
        df = getattr(t, adapter)()
        parts.append(df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("max_loaded_at")).select(
            F.lit(source).alias("source_name"), "max_loaded_at",
            F.lit(warn).alias("warn_after_hours"), F.lit(err).alias("error_after_hours")))
    u = _union(parts)
    age = F.expr(f"(unix_seconds(timestamp '{as_of} 00:00:00') - "
                 "unix_seconds(cast(max_loaded_at as timestamp))) div 3600")
    return (u.withColumn("age_hours", age)
            .withColumn("status", F.when(F.col("age_hours") >= F.col("error_after_hours"), "error")
                        .when(F.col("age_hours") >= F.col("warn_after_hours"), "warn").otherwise("pass")))


@job("audit_row_count")
def audit_row_count(t: Tables) -> DataFrame:
    pairs = [
        ("stg_transactions", t.stg_transactions(), "fct_transactions", facts.fct_transactions(t)),
        ("stg_premium_transactions", t.stg_premium_transactions(), "fct_premium", facts.fct_premium(t)),
        ("stg_claims", t.stg_claims(), "fct_claims", facts.fct_claims(t)),
        ("stg_claim_reserves_snapshots", t.stg_claim_reserves_snapshots(),
         "fct_claim_reserve_snapshots", facts.fct_claim_reserve_snapshots(t)),
    ]
    return _union([q.row_count_reconciliation(s, d, sn, dn) for sn, s, dn, d in pairs])


@job("audit_duplicates")
def audit_duplicates(t: Tables) -> DataFrame:
    """Entity-days with more than one risk score in the source."""
    s = t.stg_risk_scores().withColumn("score_day", F.col("score_date").cast("date"))
    return q.duplicates(s, ["entity_id", "entity_type", "score_day"])


@job("audit_null_check")
def audit_null_check(t: Tables) -> DataFrame:
    """Null count of every column of the claims fact (one scan)."""
    return q.null_counts(facts.fct_claims(t))


RUN = audit.RunContext(business_date=ORDERS_AS_OF, run_started_at=dt.datetime(2001, 8, 1, 6, 0, 0),
                       invocation_id="run-20010801-0600", target_name="prod")


@job("audit_columns")
def audit_columns(t: Tables) -> DataFrame:
    """Spending report with the run's audit columns."""
    return audit.with_audit_columns(reports.customer_spending_analysis(t), RUN, include_updated_at=True)


@job("audit_log")
def audit_log(t: Tables) -> DataFrame:
    """One audit-log row per model of the run, row counts taken from the models."""
    models = {"fct_premium": facts.fct_premium(t), "fct_claims": facts.fct_claims(t),
              "rpt_pra_exposures": reports.rpt_pra_exposures(t)}
    return _union([audit.audit_log_row(df, name, RUN, database="analytics", schema="marts")
                   for name, df in models.items()])
