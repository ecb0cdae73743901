"""Every registered query: the named jobs of the pipeline plus the operator
demonstrations, each over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.adapters import Tables
from . import dims, facts, insolvency, reports
from .registry import job

for _name, _fn in {
    "fct_insolvency": insolvency.fct_insolvency,
    "bankruptcy": insolvency.bankruptcy,
    "dim_account": dims.dim_account,
    "dim_claim": dims.dim_claim,
    "dim_customer": dims.dim_customer,
    "dim_product": dims.dim_product,
    "dim_reserve_type": dims.dim_reserve_type,
    "dim_policy": dims.dim_policy,
    "dim_customer_360": dims.dim_customer_360,
    "dim_account_lifecycle": dims.dim_account_lifecycle,
    "fct_orders": dims.fct_orders,
    "dim_customers": dims.dim_customers,
    "fct_transactions": facts.fct_transactions,
    "fct_account_daily_balance": facts.fct_account_daily_balance,
    "dim_account_balance_scd2": facts.dim_account_balance_scd2,
    "fct_account_daily_balance_by_month": facts.fct_account_daily_balance_by_month,
    "dim_account_balance_scd2_by_month": facts.dim_account_balance_scd2_by_month,
    "eom_balance": facts.eom_balance,
    "fct_credit_exposure": facts.fct_credit_exposure,
    "fct_premium": facts.fct_premium,
    "fct_claims": facts.fct_claims,
    "fct_claim_reserve_snapshots": facts.fct_claim_reserve_snapshots,
    "fct_claim_reserve_snapshots_pit": facts.fct_claim_reserve_snapshots_pit,
    "fct_risk_score": facts.fct_risk_score,
    "fct_loss_ratio": facts.fct_loss_ratio,
    "fct_product_performance": facts.fct_product_performance,
    "fct_suspicious_activity": facts.fct_suspicious_activity,
    "rpt_fca_returns": reports.rpt_fca_returns,
    "rpt_fca_returns_literal": reports.rpt_fca_returns_literal,
    "rpt_ifrs_balances": reports.rpt_ifrs_balances,
    "rpt_ifrs_balances_literal": reports.rpt_ifrs_balances_literal,
    "rpt_pra_exposures": reports.rpt_pra_exposures,
    "customer_spending_analysis": reports.customer_spending_analysis,
    "reserve_trend_90d": reports.reserve_trend_90d,
}.items():
    job(_name)(_fn)


# ---- calendar over the span of the data ---------------------------------------
from . import calendar_jobs  # noqa: E402,F401  (registers date_spine .. history_date_pull)


# ---- history snapshots and meter profiles --------------------------------------
from . import meter, snapshots  # noqa: E402

for _name, _fn in {
    "snap_customer_address": snapshots.snap_customer_address,
    "snap_employee_role": snapshots.snap_employee_role,
    "snap_product_price": snapshots.snap_product_price,
    "snap_orders": snapshots.snap_orders,
    "snap_hard_delete": snapshots.snap_hard_delete,
    "snap_from_change_log": snapshots.snap_from_change_log,
    "meter_profile_48": meter.meter_profile_48,
}.items():
    job(_name)(_fn)

from . import quality_jobs  # noqa: E402,F401  (registers dq_* and audit_* jobs)
from . import incremental_jobs  # noqa: E402,F401  (registers incr_* and mark filters)


# ---- join operators on their own ------------------------------------------------
@job("account_date_spine")
def account_date_spine(t: Tables) -> DataFrame:
    """Account x day from the open date to as_of (range join as a generator)."""
    from ..operators.balances import account_day_spine
    from ..sources.adapters import ORDERS_AS_OF
    return account_day_spine(t.stg_accounts().select("account_id", "account_open_date"),
                             "account_open_date", ORDERS_AS_OF).select("account_id", "balance_date")


@job("pit_policy_join")
def pit_policy_join(t: Tables) -> DataFrame:
    """Every reserve snapshot with the policy version valid on its date (left
    join: snapshots outside every version keep null policy columns)."""
    from ..operators.pit import point_in_time_join
    r = facts.reserve_snapshots(t).join(facts.claim_policy(t), "claim_id")
    pol = dims.dim_policy(t).select("policy_id", "policy_sk", "policy_status", "effective_from", "effective_to")
    return point_in_time_join(r, pol, ["policy_id"], "snapshot_date", "effective_from", "effective_to",
                              how="left")


from . import io_jobs  # noqa: E402,F401  (registers file/stream round trips)
