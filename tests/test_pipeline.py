import datetime as dt
import pathlib

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.plans import pipeline
from ledgerflow.sources.adapters import Tables
from ledgerflow.sources.files import scratch_dir
from pyspark.sql import functions as F

FACTS = ["fct_transactions", "fct_account_daily_balance", "fct_premium", "fct_claims", "fct_claim_reserve_snapshots",
         "fct_risk_score", "dim_account_balance_scd2", "fct_credit_exposure", "rpt_pra_exposures"]


def table(spark, wh, name):
    return spark.read.parquet(f"{wh}/{name}").drop(pipeline.MONTH)


def same(spark, wh, name):
    direct = E.queries()[name](spark, SF_SMALL)
    assert sorted(map(repr, table(spark, wh, name).select(*direct.columns).collect())) == sorted(map(repr, direct.collect())), name


def files(wh, name):
    root = pathlib.Path(f"{wh}/{name}".removeprefix("file:"))
    return {p.relative_to(root): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_pipeline_materialises_and_matches_direct_queries(spark):
    wh = scratch_dir(spark, "test_pipeline")
    models = ["dim_policy", "dim_customer_360", "fct_premium", "fct_claims", "fct_claim_reserve_snapshots",
              "fct_risk_score", "rpt_ifrs_balances"]
    log = {r.model_name: r.row_count for r in pipeline.run(spark, SF_SMALL, wh, models).collect()}
    assert set(log) == set(models)
    same(spark, wh, "rpt_ifrs_balances")
    assert log["rpt_ifrs_balances"] == table(spark, wh, "rpt_ifrs_balances").count()


def test_second_run_equals_a_full_build_and_leaves_old_partitions(spark):
    wh = scratch_dir(spark, "test_increment")
    cut, day = F.lit("2001-06-20").cast("date"), dt.date(2001, 6, 20)
    event_cut = F.lit("2024-01-12").cast("date")
    first = Tables(spark, SF_SMALL).restrict(
        stg_transactions=F.col("transaction_timestamp").cast("date") <= cut,
        stg_premium_transactions=F.col("posting_date").cast("date") <= cut,
        stg_claims=F.col("claim_reported_date").cast("date") <= cut,
        stg_claim_reserves_snapshots=F.col("reserve_snapshot_date") <= cut,
        stg_risk_scores=F.col("score_date").cast("date") <= event_cut,
        exposures=F.col("exposure_date") <= cut)
    pipeline.run(spark, SF_SMALL, wh, FACTS, as_of=day, tables=first)
    before = {m: files(wh, m) for m in FACTS}
    pipeline.run(spark, SF_SMALL, wh, FACTS)
    for m in FACTS:
        same(spark, wh, m)
        after = files(wh, m)
        old = {p: at for p, at in before[m].items() if p.parts[0] < f"{pipeline.MONTH}=2001-04"}
        assert m == "fct_risk_score" or old
        assert all(after.get(p) == at for p, at in old.items()), m
    pipeline.run(spark, SF_SMALL, wh, ["fct_premium"], full_refresh=True)
    assert not set(before["fct_premium"]) & set(files(wh, "fct_premium"))
    same(spark, wh, "fct_premium")


def test_checks_are_stored_with_the_run(spark):
    wh = scratch_dir(spark, "test_checks")
    pipeline.run(spark, SF_SMALL, wh, ["dim_policy"], checks=True)
    got = {r.check_name: r.failures for r in spark.read.parquet(f"{wh}/{pipeline.CHECK_LOG}").collect()}
    assert set(got) == set(pipeline.CHECKS) and got["dq_not_null"] == 0 and got["dq_no_overlap"] == 0
    assert got["dq_payment_total"] == E.queries()["dq_payment_total"](spark, SF_SMALL).count() > 0


def test_stored_snapshots_equal_the_replay(spark):
    from ledgerflow.plans.snapshots import ORDER_RUNS
    wh = scratch_dir(spark, "test_snapshots")
    for at in (*ORDER_RUNS, ORDER_RUNS[-1]):  # the last run twice
        out = pipeline.snapshot_run(spark, SF_SMALL, wh, "snap_customer_address", at)
    direct = E.queries()["snap_customer_address"](spark, SF_SMALL)
    assert sorted(map(repr, out.select(*direct.columns).collect())) == sorted(map(repr, direct.collect()))


def test_row_checks_are_counted_by_the_write(spark, monkeypatch):
    """Failures of written models are observed; the checks read none of these models again."""
    from ledgerflow.plans import quality_jobs as qj
    wh, models = scratch_dir(spark, "observed"), ["dim_policy", "dim_claim", "dim_product", "dim_customer", "dim_reserve_type"]
    monkeypatch.setitem(qj.NOT_NULL, "dim_policy", ["policy_sk", "status_end_date"])  # open versions have none
    monkeypatch.setattr(qj, "ACCEPTED", [("dim_claim", "claim_status", ["OPEN"]), ("dim_customer", "customer_type", ["PERSON", "ORGANIZATION"])])
    monkeypatch.setattr(qj, "EXPRESSIONS", [("dim_policy", "premium_amount < 0")])
    scanned = []
    for m in models:
        monkeypatch.setitem(qj.MODELS, m, lambda t, m=m, f=qj.MODELS[m]: scanned.append(m) or f(t))
    monkeypatch.setattr(pipeline, "CHECKS", sorted(pipeline.OBSERVED))
    pipeline.run(spark, SF_SMALL, wh, models, checks=True)
    assert scanned == []
    got = {r.check_name: r.failures for r in spark.read.parquet(f"{wh}/{pipeline.CHECK_LOG}").collect()}
    policies, claims = table(spark, wh, "dim_policy"), table(spark, wh, "dim_claim")
    assert got == {"dq_not_null": policies.where("status_end_date is null").count(), "dq_accepted_values": claims.where("claim_status <> 'OPEN'").count(),
                   "dq_expression": policies.where("not premium_amount < 0").count()}
    assert got["dq_not_null"] > 0 and got["dq_accepted_values"] > 0
