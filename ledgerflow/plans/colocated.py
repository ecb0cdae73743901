"""The inputs of account and policy jobs as bucketed tables, so that these jobs plan no exchange of them.

``store`` writes each input once; ``tables`` gives a handle on which the jobs
read them: ``facts.fct_credit_exposure(h)``, ``reports.rpt_ifrs_balances(h)``. Joins on
(policy, month) use that both sides are dealt by policy alone where
``spark.sql.requireAllClusterKeysForCoPartition`` is false; with Spark's default they are dealt again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.bucketed import BUCKETS, attach, write_bucketed
from ..sources.adapters import Tables
from . import dims, facts, reports

# input -> (key, builder)
INPUTS = {
    "fct_account_daily_balance": ("account_id", facts.fct_account_daily_balance),
    "exposure_context": ("account_id", facts.exposure_context),
    "current_policy": ("policy_id", dims.current_policy),
    "premium_amounts": ("policy_id", facts.premium_amounts),
    "claim_amounts": ("policy_id", facts.claim_amounts),
    "reserves_with_policy": ("policy_id", reports.reserves_with_policy),
    "ifrs_contract_metrics": ("policy_id", reports.ifrs_contract_metrics),
}


def _name(prefix: str, name: str) -> str:
    return f"{prefix}_{name}"


def store(t: Tables, warehouse: str, prefix: str = "colocated", buckets: int = BUCKETS) -> Tables:
    """Write all inputs under ``warehouse``; the handle that reads them."""
    for name, (key, build) in INPUTS.items():
        write_bucketed(build(t), _name(prefix, name), f"{warehouse.rstrip('/')}/{name}", [key], buckets)
    return tables(t.spark, t.sf_dir, warehouse, prefix, buckets)


def tables(spark: SparkSession, sf_dir: str, warehouse: str, prefix: str = "colocated", buckets: int = BUCKETS) -> Tables:
    t = Tables(spark, sf_dir)
    for name, (key, _) in INPUTS.items():
        t.materialized[name] = attach(spark, _name(prefix, name), f"{warehouse.rstrip('/')}/{name}", [key], buckets)
    return t
