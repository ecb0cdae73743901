"""Incremental operators: properties (merge twice = merge once, incremental =
full) and the partition overwrite."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerflow.operators import incremental as inc
from ledgerflow.operators.balances import daily_balances, incremental_daily_balances, window_balances
from ledgerflow.sources.files import scratch_dir

D = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, d date")


def test_merge_twice_equals_merge_once(spark):
    tgt = frame(spark, [(1, "a", D), (2, "b", D)])
    upd = frame(spark, [(2, "B", D), (3, "c", D)])
    once = inc.merge(tgt, upd, ["k"])
    twice = inc.merge(once, upd, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_rejects_duplicate_update_keys(spark):
    with pytest.raises(inc.DuplicateKeyError):
        inc.merge(None, frame(spark, [(1, "a", D), (1, "b", D)]), ["k"], check_unique=True)


def test_append_is_idempotent_on_boundary(spark):
    tgt = frame(spark, [(1, "a", D)])
    new = frame(spark, [(1, "a", D), (2, "b", D)])
    assert inc.append_new(inc.append_new(tgt, new, ["k"]), new, ["k"]).count() == 2


def test_hwm_filter_null_safe_and_strict(spark):
    src = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(days=1))])
    assert inc.hwm_filter(src, "d", None, "d").count() == 2            # empty target: 1900-01-01
    empty = src.where("false")
    assert inc.hwm_filter(src, "d", empty, "d").count() == 2
    assert inc.hwm_filter(src, "d", src.where("k = 1"), "d").count() == 1
    assert inc.incremental_filter(src, "d", src.where("k = 1")).count() == 2


def test_insert_overwrite_replaces_whole_partitions(spark):
    tgt = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(days=40))])
    new = frame(spark, [(3, "c", D)])
    got = sorted(r.k for r in inc.insert_overwrite(tgt, new, ["d"]).collect())
    assert got == [2, 3]


def test_schema_sync(spark):
    old = spark.createDataFrame([(1, "x")], "k int, gone string")
    new = spark.createDataFrame([(2, 5)], "k int, added int")
    out = inc.schema_sync(old, new)
    assert out.columns == ["k", "added"]
    assert sorted((r.k, r.added) for r in out.collect()) == [(1, None), (2, 5)]


def test_incremental_balances_equal_full(spark):
    acc = spark.createDataFrame([(1, D, Decimal("100.00"), "GBP"), (2, D + dt.timedelta(days=25),
                                                                    Decimal("5.00"), "EUR")],
                                "account_id long, account_open_date date, opening_balance decimal(18,2), "
                                "currency_code string")
    amt = spark.createDataFrame([(1, D, Decimal("10.00")), (1, D + dt.timedelta(days=19), Decimal("5.00")),
                                 (2, D + dt.timedelta(days=26), Decimal("1.00"))],
                                "account_id long, balance_date date, daily_net_amount decimal(18,2)")
    as1, as2 = D + dt.timedelta(days=15), D + dt.timedelta(days=30)
    full = daily_balances(acc, amt, as2, partitions=4)
    run1 = daily_balances(acc, amt, as1, partitions=4)
    new = incremental_daily_balances(run1, acc, amt, D + dt.timedelta(days=10), as2, partitions=4)
    merged = inc.merge(run1, new, ["account_id", "balance_date"])
    assert sorted(merged.collect()) == sorted(full.collect())
    last = [r for r in merged.collect() if r.account_id == 1 and r.balance_date == as2][0]
    assert last.closing_balance == Decimal("115.00")   # literal increment would give 105


def test_window_balances_equal_the_full_spine(spark):
    acc = spark.createDataFrame([(1, D, Decimal("100.00"), "GBP"), (2, D + dt.timedelta(days=25), Decimal("5.00"), "EUR")],
                                "account_id long, account_open_date date, opening_balance decimal(18,2), currency_code string")
    amt = spark.createDataFrame([(1, D - dt.timedelta(days=1), Decimal("7.00")), (1, D, Decimal("10.00")),
                                 (1, D + dt.timedelta(days=19), Decimal("5.00")), (2, D + dt.timedelta(days=26), Decimal("1.00"))],
                                "account_id long, balance_date date, daily_net_amount decimal(18,2)")
    since, as_of = D + dt.timedelta(days=10), D + dt.timedelta(days=30)
    full = daily_balances(acc, amt, as_of, partitions=4).where(f"balance_date >= date '{since}'")
    assert sorted(window_balances(acc, amt, since, as_of, partitions=4).collect()) == sorted(full.collect())


def test_restricted_views_combine_and_start_unmaterialised(spark, tables):
    from ledgerflow.plans import facts
    from pyspark.sql import functions as F
    n = lambda t: t.stg_premium_transactions().count()
    low = tables.restrict(stg_premium_transactions=F.col("policy_id") < 10)
    both = low.restrict(stg_premium_transactions=F.col("policy_id") > 5)
    assert 0 < n(both) < n(low) and n(both) == tables.stg_premium_transactions().where("policy_id < 10 and policy_id > 5").count()
    full = type(tables)(spark, tables.sf_dir)
    full.materialized["fct_premium"] = facts.fct_premium(tables)
    assert facts.fct_premium(full.restrict(stg_premium_transactions=F.col("policy_id") < 10)).count() == facts.fct_premium(low).count() > 0


def test_appending_on_the_mark_reads_the_boundary_only(spark):
    tgt = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(days=1))])
    new = frame(spark, [(2, "b", D + dt.timedelta(days=1)), (3, "c", D + dt.timedelta(days=1))])
    assert sorted(r.k for r in inc.append_new(tgt, new, ["k"], boundary="d").collect()) == [1, 2, 3]


def test_partition_overwrite_sink(spark):
    path = scratch_dir(spark, "test_partitions")
    df = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(days=40))])
    inc.write_partitions(df, path, ["d"])
    inc.write_partitions(frame(spark, [(3, "c", D)]), path, ["d"])
    got = sorted(r.k for r in spark.read.parquet(path).collect())
    assert got == [2, 3]


def test_insert_overwrite_null_partition(spark):
    tgt = spark.createDataFrame([(1, None), (2, D)], "k int, d date")
    new = spark.createDataFrame([(3, None)], "k int, d date")
    assert sorted(r.k for r in inc.insert_overwrite(tgt, new, ["d"]).collect()) == [2, 3]


def test_merge_once_takes_updates_and_keeps_the_rest(spark):
    schema = "k string, d int, v int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), (None, 1, 3), ("c", None, 4)], schema)
    new = spark.createDataFrame([("b", 1, 20), ("d", 2, None), (None, 1, 30)], schema)
    got = inc.merge_once(old, new, ["k", "d"])
    assert got.columns == ["k", "d", "v"]
    assert sorted(got.collect(), key=repr) == sorted(inc.merge(old, new, ["k", "d"]).collect(), key=repr)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_spending_increment_reads_the_lines_once_a_run(spark):
    """A touched group is recomputed from all its rows, without a second pass for its keys."""
    from ledgerflow.plans import incremental_jobs as jobs
    from ledgerflow.sources.adapters import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = jobs.incr_spending(t)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("l_extendedprice" in line and line.strip(" :+-").startswith("Relation") for line in plan.splitlines()) == 1
    assert "LeftSemi" not in plan and "LeftAnti" not in plan


def test_stored_run_is_read_by_column_and_day(spark):
    from ledgerflow.plans import incremental_jobs as jobs
    run = spark.range(10).selectExpr("id", "date_add(date'2024-01-01', int(id)) as d", "cast(id as decimal(38,2)) as m", "cast(null as string) as s")
    kept = jobs.stored(run)
    assert kept.schema.simpleString() == run.schema.simpleString()
    assert sorted(kept.collect()) == sorted(run.collect())
    assert jobs.stored(run.where("id < 0")).count() == 0
    plan = kept.where("d = date'2024-01-03'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(d), EqualTo(d," in plan and "ReadSchema: struct<id:bigint,d:date>" in plan
