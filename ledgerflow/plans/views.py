"""SQL access: every model as a temporary view (IO9, view materialisation).

    from ledgerflow.plans.views import register_views
    register_views(spark, "/data/sf1")
    spark.sql("select account_id, max_by(closing_balance, balance_date) ... from fct_account_balance_daily ...")

Views are lazy: a query over them is planned and optimised by Catalyst as one
plan, with the models' own pushdown and pruning. Models written by
``plans.pipeline`` can be registered instead by passing a Tables handle whose
``materialized`` map holds them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.adapters import Tables
from . import calendar_jobs, dims, facts, insolvency, reports

MODELS = {
    "dim_account": dims.dim_account, "dim_claim": dims.dim_claim, "dim_customer": dims.dim_customer,
    "dim_product": dims.dim_product, "dim_reserve_type": dims.dim_reserve_type, "dim_policy": dims.dim_policy,
    "dim_customer_360": dims.dim_customer_360, "dim_account_lifecycle": dims.dim_account_lifecycle,
    "dim_calendar": calendar_jobs.data_calendar, "dim_customers": dims.dim_customers,
    "fct_orders": dims.fct_orders, "fct_transactions": facts.fct_transactions,
    "fct_account_daily_balance": facts.fct_account_daily_balance,
    "dim_account_balance_scd2": facts.dim_account_balance_scd2,
    "fct_credit_exposure": facts.fct_credit_exposure, "fct_premium": facts.fct_premium,
    "fct_claims": facts.fct_claims, "fct_claim_reserve_snapshots": facts.fct_claim_reserve_snapshots,
    "fct_risk_score": facts.fct_risk_score, "fct_loss_ratio": facts.fct_loss_ratio,
    "fct_product_performance": facts.fct_product_performance,
    "fct_suspicious_activity": facts.fct_suspicious_activity, "fct_insolvency": insolvency.fct_insolvency,
    "bankruptcy": insolvency.bankruptcy, "rpt_fca_returns": reports.rpt_fca_returns,
    "rpt_ifrs_balances": reports.rpt_ifrs_balances, "rpt_pra_exposures": reports.rpt_pra_exposures,
    "customer_spending_analysis": reports.customer_spending_analysis,
}
# Other names the models are known by.
ALIASES = {"fct_account_balance_daily": "fct_account_daily_balance", "dim_date": "dim_calendar"}


def register_views(spark: SparkSession, sf_dir: str | None = None, tables: Tables | None = None) -> list[str]:
    t = tables or Tables(spark, sf_dir)
    names = []
    for name, build in MODELS.items():
        build(t).createOrReplaceTempView(name)
        names.append(name)
    for alias, name in ALIASES.items():
        spark.table(name).createOrReplaceTempView(alias)
        names.append(alias)
    return names
