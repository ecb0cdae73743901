"""Account and policy jobs over bucketed inputs: no exchange, same rows."""

import uuid

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.operators.bucketed import attach
from ledgerflow.plans import colocated, facts, reports
from ledgerflow.sources.adapters import Tables
from ledgerflow.sources.files import scratch_dir


def rows(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.fixture
def settings(spark):
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_jobs_over_bucketed_inputs_plan_no_exchange(spark, settings):
    prefix, wh = f"co_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "colocated")
    t = colocated.store(Tables(spark, SF_SMALL), wh, prefix, buckets=4)
    try:
        for name, job in (("fct_credit_exposure", facts.fct_credit_exposure), ("rpt_ifrs_balances", reports.rpt_ifrs_balances),
                          ("rpt_ifrs_balances_literal", reports.rpt_ifrs_balances_literal)):
            got, direct = job(t), E.queries()[name](spark, SF_SMALL)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
            assert "Exchange" in direct._jdf.queryExecution().executedPlan().toString()
            assert got.dtypes == direct.dtypes and rows(got, direct.columns) == rows(direct, direct.columns)
    finally:
        for name in colocated.INPUTS:
            spark.sql(f"drop table if exists {prefix}_{name}")


def test_a_new_catalog_finds_the_buckets_again(spark, settings):
    prefix, wh = f"co_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "attached")
    colocated.store(Tables(spark, SF_SMALL), wh, prefix, buckets=3)
    name = f"{prefix}_fct_account_daily_balance"
    want = spark.table(name).count()
    spark.sql(f"drop table {name}")  # external: the files stay
    table = attach(spark, name, f"{wh}/fct_account_daily_balance", ["account_id"], 3)
    assert table.count() == want
    assert "Exchange" not in table.groupBy("account_id").count()._jdf.queryExecution().executedPlan().toString()
    for n in colocated.INPUTS:
        spark.sql(f"drop table if exists {prefix}_{n}")
