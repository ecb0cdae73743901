"""Driver contract and the DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.plans.registry import load_all
from tools.check_oracle import TABLES, norm

# Keys of the library's own jobs; the subpackage of the numbered operators has tests of its own.
JOBS = sorted(load_all())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"account_id", "balance_date", "closing_balance"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert not set(JOBS) - set(E.oracle_sql())


def _duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", JOBS)
def test_matches_oracle(spark, name):
    con = _duck(SF_SMALL)
    st = E.queries()[name](spark, SF_SMALL).toArrow()
    dt = con.sql(E.oracle_sql()[name]).arrow()
    if hasattr(dt, "read_all"):
        dt = dt.read_all()
    cols = sorted(st.column_names)
    assert cols == sorted(dt.column_names)
    for c in cols:
        assert str(st.schema.field(c).type) == str(dt.schema.field(c).type), c
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in st.to_pylist()), key=repr)
    drows = sorted((tuple(norm(r[c]) for c in cols) for r in dt.to_pylist()), key=repr)
    assert srows == drows


def test_current_customer_shortcut_equals_history_filter(spark):
    from ledgerflow.plans import dims
    from ledgerflow.sources.adapters import Tables
    t = Tables(spark, SF_SMALL)
    fast = dims.current_customer(t)
    slow = (dims.dim_customer_360(t).where("is_current_record")
            .selectExpr("customer_id", "risk_rating", "country_code as customer_country"))
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_entry_without_the_subpackage():
    """The other queries load where the subpackage and the pipeline are not there."""
    import subprocess
    import sys
    code = ("import sys; sys.modules['ledgerflow.llm'] = None\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) == len(e.load_all()) and set(e.oracle_sql()) <= set(e.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(E.__file__)))


def test_daily_balance_sums_orders_before_any_exchange(spark):
    from ledgerflow.plans import facts
    from ledgerflow.sources.adapters import Tables
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = facts.daily_net(Tables(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "customer" not in plan and "nation" not in plan and "Join" not in plan
    assert plan.index("Exchange hashpartitioning") < plan.rindex("partial_sum") < plan.index("FileScan")
    assert plan.count("Exchange") == 1


def test_scratch_folder_must_be_shared_off_local_mode(spark):
    from types import SimpleNamespace
    from ledgerflow.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def _below(plan: str, node: str) -> list[str]:
    """The subtrees of a plan's text whose root names ``node``."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    out = []
    for i, line in enumerate(lines):
        if node in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            out.append("\n".join(lines[i + 1:end]))
    return out


SPINE_KEYS = ["account_date_spine", "fct_account_daily_balance", "fct_credit_exposure", "dim_account_balance_scd2", "eom_balance", "lookback_filter",
              "rpt_pra_exposures", "dq_unique", "dq_unique_combo", "dq_not_null", "dq_relationships"]


@pytest.mark.parametrize("name", SPINE_KEYS)
def test_no_generated_account_days_are_broadcast(spark, name):
    """Catalyst takes a generated spine for one row per account: it must never be a broadcast side."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [t for t in _below(plan, "BroadcastExchange") if "explode(sequence(account_open_date" in t]


def test_a_broadcast_spine_would_be_seen(spark):
    from ledgerflow.operators.balances import account_day_spine
    accounts = spark.createDataFrame([(1, "2020-01-01")], "account_id long, d string").selectExpr("account_id", "cast(d as date) account_open_date")
    spine = account_day_spine(accounts, "account_open_date", "2020-02-01")
    plan = spark.range(9).toDF("account_id").join(spine.hint("broadcast"), "account_id")._jdf.queryExecution().executedPlan().toString()
    assert any("explode(sequence(account_open_date" in t for t in _below(plan, "BroadcastExchange"))


def test_exposure_context_joins_accounts_not_days(spark):
    """No join above the generated days."""
    plan = E.queries()["fct_credit_exposure"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("explode(sequence(")]
    assert "Join" not in above and "Window" in above


def test_shuffles_start_with_more_partitions_on_a_larger_input(spark, monkeypatch):
    """What a task of the spending report holds does not grow with the input; rows stay."""
    from ledgerflow import session
    from ledgerflow.plans import reports
    from ledgerflow.sources.adapters import Tables
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = reports.customer_spending_analysis(Tables(spark, SF_SMALL))
    want = plain.collect()
    assert int(spark.conf.get(session.INITIAL)) == default
    monkeypatch.setattr(session, "INPUT_BYTES_A_PARTITION", 5000)
    t = Tables(spark, SF_SMALL)
    got = reports.customer_spending_analysis(t)
    n = -(-sum(t._bytes.values()) // 5000)
    assert n > default and sum(t._bytes.values()) == sum(os.path.getsize(f"{SF_SMALL}/{x}.parquet") for x in t._raw)
    assert sorted(got.collect(), key=repr) == sorted(want, key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reports.customer_spending_analysis(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert f", {n})" in plan or f", {n}, ENSURE_REQUIREMENTS" in plan or f"{n}), ENSURE" in plan
    monkeypatch.undo()
    Tables(spark, SF_SMALL).raw("lineitem")
    assert int(spark.conf.get(session.INITIAL)) == default
