"""Run the pipeline as a whole: every model is built once, written, and read
back by the models downstream of it (table materialisation, IO10).

    python -m ledgerflow.plans.pipeline --sf-dir DIR --warehouse DIR [--models a,b] [--full-refresh]

Models with a date are partitioned by its month. A run that finds such a table
reads its high-water mark, computes only the months from the lookback on, and
replaces these partitions by Spark's dynamic partition overwrite; all other
partitions keep their files. A partition of the window that has no row any more is removed.
Models that are merged by key are dealt into buckets of their key (``operators.stored``): a run
computes the rows that changed since the stored mark and rewrites only the buckets they touch. Models that
follow column changes have a registry of their columns. ``full_refresh`` rebuilds every table. Each write
observes its row count and appends one row to the audit log at ``_audit_log``; with
``checks`` the quality checks run on the written tables and their failures go to
``_checks``. ``snapshot_run`` applies one snapshot run to a stored history.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators import incremental as inc
from ..operators import stored
from ..operators.audit import RunContext, append_log, write_observed
from ..operators.balances import incremental_daily_balances
from ..sources.adapters import ORDERS_AS_OF, Tables
from ..sources.files import absent, discard, partitions
from . import dims, facts, quality_jobs, reports, snapshots
from .registry import load_all

# Build order: dimensions, then facts, then what reads them.
ORDER = [
    "dim_policy", "dim_customer_360", "dim_account_lifecycle", "dim_account", "dim_claim", "dim_customer",
    "dim_product", "dim_reserve_type", "dim_calendar",
    "fct_transactions", "fct_account_daily_balance", "fct_premium", "fct_claims",
    "fct_claim_reserve_snapshots", "fct_risk_score",
    "dim_account_balance_scd2", "fct_credit_exposure", "fct_insolvency", "fct_loss_ratio",
    "fct_product_performance", "fct_suspicious_activity", "fct_orders", "dim_customers",
    "rpt_fca_returns", "rpt_ifrs_balances", "rpt_pra_exposures", "bankruptcy", "customer_spending_analysis",
    "reserve_trend_90d", "eom_balance", "meter_profile_48",
]
MONTH = "part_month"
AUDIT_LOG, CHECK_LOG = "_audit_log", "_checks"
CHECKS = ["dq_not_null", "dq_unique", "dq_unique_combo", "dq_relationships", "dq_relationships_where", "dq_accepted_values",
          "dq_expression", "dq_no_overlap", "dq_policy_pit", "dq_payment_total", "dq_freshness"]
OBSERVED = {"dq_not_null", "dq_accepted_values", "dq_expression"}  # counted while models are written
# Stored histories: keys, change time, and the source's state at a run time.
SNAPSHOTS = {
    "snap_orders": (["order_id"], "updated_at", snapshots.order_state),
    "snap_customer_address": (["customer_id"], "last_updated_at", lambda t, at: snapshots.state_at(
        t.crm_customer_changes(), ["customer_id"], "last_updated_at", at, "change_id", snapshots.ADDRESS_COLS)),
    "snap_employee_role": (["employee_id"], "role_last_updated", lambda t, at: snapshots.state_at(
        t.hr_employee_roles(), ["employee_id"], "role_last_updated", at, "change_id",
        ["employee_id", "role", "department", "role_last_updated"])),
    "snap_product_price": (["product_code"], "last_updated_at", lambda t, at: snapshots.state_at(
        t.product_prices(), ["product_code"], "last_updated_at", at, "change_id", ["product_code", "price", "last_updated_at"])),
}


HARD_DELETES = {"snap_orders"}  # snapshots that close versions whose key left the source
SYNCED = {"fct_claim_reserve_snapshots", "dim_account_balance_scd2"}  # models whose columns follow the latest write
MARKS = "_marks"


@dataclass(frozen=True)
class MergedByKey:
    """How a model is merged: its key, the rows changed since a time, and the newest change of its source."""

    keys: list[str]
    changes: Callable[[Tables, DataFrame, dt.datetime], DataFrame]
    newest: Callable[[Tables], DataFrame]
    lookback_days: int = 14


def _newest_order(t: Tables) -> DataFrame:
    return t.stg_orders().agg(F.max("updated_at").alias("mark"))


MERGED = {
    "fct_orders": MergedByKey(["order_id"], dims.fct_orders_changes, _newest_order),
    "dim_customers": MergedByKey(["customer_id"], dims.dim_customers_changes, _newest_order),
    "customer_spending_analysis": MergedByKey(
        reports.SPENDING_KEYS, reports.customer_spending_changes,
        lambda t: t.retail_daily_transactions().agg(F.max("last_updated_at").alias("mark"))),
}


@dataclass(frozen=True)
class Incremental:
    """How a model is loaded in increments: the date its partitions follow, the
    days to look back, the source columns that the window restricts, and the
    builder of the window's rows."""

    date: str
    build: Callable[..., DataFrame]
    sources: dict[str, str] = field(default_factory=dict)
    lookback_days: int = 14


def _balance_window(t: Tables, target: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    acc = t.stg_accounts().select("account_id", "account_open_date", "opening_balance", "currency_code")
    rows = incremental_daily_balances(target, acc, facts.daily_net(t), start, as_of)
    return rows.select(surrogate_key("account_id", "balance_date").alias("account_balance_sk"), "account_id", "balance_date",
                       "currency_code", "daily_net_amount", "opening_balance", "closing_balance").checkpoint(eager=True)


def _period_window(t: Tables, target: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Periods that end in the month before the window or later: the partitions to replace."""
    days = facts.fct_account_daily_balance(t).where(F.col("balance_date") >= F.lit(str(start)).cast("date"))
    kept, rebuilt = facts.balance_periods_increment(target, days, start)
    before = F.lit(str((start - dt.timedelta(days=1)).replace(day=1))).cast("date")
    periods = kept.where(F.col("effective_end_date") >= before).select(*rebuilt.columns).unionByName(rebuilt)
    return facts.balance_periods_rows(periods, F.lit(str(as_of)).cast("date")).checkpoint(eager=True)


def _exposure_window(t: Tables, target: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    days = facts.fct_account_daily_balance(t).where(F.col("balance_date") >= F.lit(str(start)).cast("date"))
    return facts.fct_credit_exposure(t, days)


INCREMENTAL = {
    "fct_transactions": Incremental("transaction_date", facts.fct_transactions, {"stg_transactions": "transaction_timestamp"}),
    "fct_account_daily_balance": Incremental("balance_date", _balance_window),
    "fct_premium": Incremental("premium_date", facts.fct_premium, {"stg_premium_transactions": "posting_date"}),
    "fct_claims": Incremental("claim_reported_date", facts.fct_claims, {"stg_claims": "claim_reported_date"}),
    "fct_claim_reserve_snapshots": Incremental("snapshot_date", facts.fct_claim_reserve_snapshots,
                                               {"stg_claim_reserves_snapshots": "reserve_snapshot_date"}),
    "fct_risk_score": Incremental("score_date", facts.fct_risk_score, {"stg_risk_scores": "score_date"}),
    "dim_account_balance_scd2": Incremental("effective_end_date", _period_window),
    "fct_credit_exposure": Incremental("balance_date", _exposure_window, lookback_days=7),
    "rpt_pra_exposures": Incremental("reporting_period", reports.rpt_pra_exposures, {"exposures": "exposure_date"}),
}


def _increment(t: Tables, spec: Incremental, target: DataFrame, as_of: dt.date) -> tuple[DataFrame, str] | None:
    """(rows of the window's months, first of these months), or None where the table is empty."""
    mark = inc.high_water_mark(target, spec.date, None)
    if mark is None:
        return None
    mark = mark.date() if isinstance(mark, dt.datetime) else mark
    start = (mark - dt.timedelta(days=spec.lookback_days)).replace(day=1)
    if not spec.sources:
        # the period that reaches the window ends in the month before it at the earliest
        first = start - dt.timedelta(days=1) if spec.build is _period_window else start
        return spec.build(t, target, start, as_of), first.strftime("%Y-%m")
    since = F.lit(str(start)).cast("date")
    return spec.build(t.restrict(**{a: F.col(c).cast("date") >= since for a, c in spec.sources.items()})), start.strftime("%Y-%m")


def _merge(spark: SparkSession, t: Tables, name: str, root: str, run: RunContext, full_refresh: bool) -> None:
    """Merge what changed since the model's mark, then move the mark: a run that fails in between repeats itself."""
    path, marks, spec = f"{root}/{name}", f"{root}/{MARKS}/{name}", MERGED[name]
    if full_refresh:
        discard(spark, path)
        discard(spark, marks)
    stored.recover(spark, path)
    mark = None if absent(spark, marks) or absent(spark, path) else spark.read.parquet(marks).agg(F.max("mark")).first()[0]
    newest = spec.newest(t).first()["mark"]
    rows = load_all()[name](t) if mark is None else spec.changes(t, stored.read_merged(spark, path), mark - dt.timedelta(days=spec.lookback_days))
    done = stored.merge_stored(spark, path, rows, spec.keys)
    append_log(spark, name, run, f"{root}/{AUDIT_LOG}", done.rows)
    spark.createDataFrame([(newest, run.invocation_id)], "mark timestamp_ntz, invocation_id string").coalesce(1).write.mode("append").parquet(marks)
    t.materialized[name] = stored.read_merged(spark, path)


def _full(name: str, t: Tables, as_of: dt.date) -> DataFrame:
    if name == "fct_account_daily_balance":
        return facts.fct_account_daily_balance(t, as_of=as_of)
    return load_all()[name](t)


def run(spark: SparkSession, sf_dir: str, warehouse: str, models: list[str] | None = None, run: RunContext | None = None,
        full_refresh: bool = False, as_of: dt.date = ORDERS_AS_OF, tables: Tables | None = None, checks: bool = False) -> DataFrame:
    """Build the models; the audit rows of this run."""
    run = run or RunContext(as_of, dt.datetime.now().replace(microsecond=0), "pipeline", "dev")
    t = tables or Tables(spark, sf_dir)
    root = warehouse.rstrip("/")
    wanted = set(models or ORDER)
    unknown = wanted - set(ORDER)
    if unknown:
        raise ValueError(f"no such models: {sorted(unknown)}")
    measured: dict[str, dict[tuple[str, str], int]] = {}
    for name in (m for m in ORDER if m in wanted):
        path, spec = f"{root}/{name}", INCREMENTAL.get(name)
        if name in MERGED:
            _merge(spark, t, name, root, run, full_refresh)
            continue
        found = None
        if spec and not full_refresh and not absent(spark, path):
            found = _increment(t, spec, _read(spark, path, name).drop(MONTH), as_of)
        touched = found is not None
        rows = found[0] if touched else _full(name, t, as_of)
        counted = quality_jobs.write_metrics(name) if checks else {}
        failing = Observation(f"checks_{name}")
        if counted:
            rows = rows.observe(failing, *[c.alias(f"m{i}") for i, c in enumerate(counted.values())])
        if name in SYNCED:
            if not touched:
                stored.forget_columns(spark, path)
            rows = stored.register_columns(spark, path, rows)
        if spec:
            rows = rows.withColumn(MONTH, F.date_format(spec.date, "yyyy-MM"))
        done = write_observed(rows, path, name, run, f"{root}/{AUDIT_LOG}", partition_by=[MONTH] if spec else None, only_touched=touched)
        if counted:
            measured[name] = {k: failing.get[f"m{i}"] for i, k in enumerate(counted)}
        if touched:  # months of the window that lost all their rows
            for month in partitions(spark, path, MONTH):
                if month >= found[1] and month not in done.partitions:
                    discard(spark, f"{path}/{MONTH}={month}")
        t.materialized[name] = _read(spark, path, name).drop(MONTH)
    if checks:
        check_results(t, run, measured).write.mode("append").parquet(f"{root}/{CHECK_LOG}")
    log = spark.read.parquet(f"{root}/{AUDIT_LOG}")
    return log.where((F.col("invocation_id") == run.invocation_id)
                     & (F.col("run_started_at") == F.lit(run.run_started_at.isoformat(sep=" ")).cast("timestamp_ntz"))
                     & F.col("model_name").isin(*sorted(wanted)))


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return stored.read_synced(spark, path, [MONTH]) if name in SYNCED else spark.read.parquet(path)


def check_results(t: Tables, run: RunContext, measured: dict[str, dict[tuple[str, str], int]] | None = None) -> DataFrame:
    """check_name, failures, run of every quality check over the handle's (written) tables.
    ``measured``: failures that the writes of models have counted, by model and check."""
    jobs, out, measured = load_all(), None, measured or {}
    for name in CHECKS:
        known = sum(n for of in measured.values() for (check, _), n in of.items() if check == name)
        df = jobs[name](t, set(measured)) if name in OBSERVED else jobs[name](t)
        if df is None:  # every model of the check was written by this run
            df = t.spark.range(0).select(F.lit(0).cast("long").alias("failures"))
        failures = (F.sum("failures") if "failures" in df.columns else
                    F.count_if(F.col("status") == "error") if "status" in df.columns else F.count(F.lit(1)))
        row = df.agg((F.coalesce(failures, F.lit(0)) + known).cast("long").alias("failures")).select(
            F.lit(name).alias("check_name"), "failures", F.lit(run.invocation_id).alias("invocation_id"),
            F.lit(run.run_started_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_started_at"))
        out = row if out is None else out.unionByName(row)
    return out


def snapshot_run(spark: SparkSession, sf_dir: str, warehouse: str, name: str, run_ts: str, tables: Tables | None = None) -> DataFrame:
    """Apply one run to the stored history of ``name``; the history after it. A run writes what
    is open and what it closed, nothing else (``stored.snapshot_store``)."""
    keys, updated_at, state = SNAPSHOTS[name]
    return stored.snapshot_store(spark, f"{warehouse.rstrip('/')}/{name}", state(tables or Tables(spark, sf_dir), run_ts),
                                 keys, updated_at, run_ts, name in HARD_DELETES)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--models", default="")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--checks", action="store_true")
    a = ap.parse_args()
    spark = SparkSession.builder.getOrCreate()
    from ..session import apply_job_configs, ensure_checkpoint_dir
    apply_job_configs(spark)
    ensure_checkpoint_dir(spark)
    run(spark, a.sf_dir, a.warehouse, [m for m in a.models.split(",") if m] or None, full_refresh=a.full_refresh,
        checks=a.checks).show(100, False)


if __name__ == "__main__":
    main()
