"""Hand-computed edge cases for the building blocks (nulls, ties, gaps, signs)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.keys import surrogate_key
from ledgerflow.functions.money import ratio, signed_amount
from ledgerflow.operators import calendar as cal
from ledgerflow.operators import quality as q
from ledgerflow.operators.balances import daily_balances
from ledgerflow.operators.islands import close_last_period, day_periods
from ledgerflow.operators.scd2 import VALID_TO, compress_runs, snapshot_apply

D = dt.date(2024, 1, 10)


def days(n):
    return D + dt.timedelta(days=n)


def test_insolvency_gaps(spark):
    ev = spark.createDataFrame([(1, 7, "IVA", days(0)), (1, 7, "IVA", days(0)), (1, 7, "IVA", days(1)),
                                (1, 7, "IVA", days(3))], "account_id long, customer_id long, code string, d date")
    p = day_periods(ev, ["account_id"], ["account_id", "customer_id", "code"], "d", "grp", "s", "e")
    out = close_last_period(p, ["account_id"], "e", "current").orderBy("s").collect()
    assert [(r.s, r.e, r.current) for r in out] == [(days(0), days(1), False), (days(3), None, True)]


def test_balance_runs_null_never_equal(spark):
    rows = [(1, days(i), v) for i, v in enumerate([10, 10, None, None, 10])]
    df = spark.createDataFrame(rows, "account_id long, d date, bal int")
    out = compress_runs(df, ["account_id"], "d", ["bal"]).orderBy("effective_start_date").collect()
    assert [(r.bal, r.effective_start_date, r.effective_end_date) for r in out] == [
        (10, days(0), days(1)), (None, days(2), days(2)), (None, days(3), days(3)), (10, days(4), days(4))]


def test_daily_balance_hand_frame(spark):
    acc = spark.createDataFrame([(1, days(0), Decimal("100.00"), "GBP")],
                                "account_id long, account_open_date date, opening_balance decimal(18,2), "
                                "currency_code string")
    amt = spark.createDataFrame([(1, days(0), Decimal("-30.00")), (1, days(2), Decimal("5.00")),
                                 (1, days(-5), Decimal("999.00"))],  # before opening: ignored
                                "account_id long, balance_date date, daily_net_amount decimal(18,2)")
    out = daily_balances(acc, amt, days(2), partitions=4).orderBy("balance_date").collect()
    assert [float(r.closing_balance) for r in out] == [70.0, 70.0, 75.0]
    assert [float(r.opening_balance) for r in out] == [100.0, 70.0, 70.0]
    assert [float(r.daily_net_amount) for r in out] == [-30.0, 0.0, 5.0]


def test_daily_balance_plan_does_not_shuffle_the_spine(spark):
    acc = spark.createDataFrame([(i, days(0), Decimal("1.00"), "GBP") for i in range(10)],
                                "account_id long, account_open_date date, opening_balance decimal(18,2), "
                                "currency_code string")
    amt = spark.createDataFrame([(1, days(0), Decimal("1.00"))],
                                "account_id long, balance_date date, daily_net_amount decimal(18,2)")
    plan = daily_balances(acc, amt, days(30), partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    # two exchanges: the accounts and the daily amounts; none above the union
    assert plan.count("Exchange hashpartitioning") == 2


def snap_frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, u timestamp_ntz")


def test_snapshot_apply_change_keep_new_delete(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    run1 = snap_frame(spark, [("a", 1, t0), ("b", 1, t0), ("d", 1, t0)])
    run2 = snap_frame(spark, [("a", 2, t1), ("b", 1, t0), ("c", 1, t1)])
    h1 = snapshot_apply(None, run1, ["k"], "u")
    h2 = snapshot_apply(h1, run2, ["k"], "u", F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"), hard_delete=True)
    got = sorted((r.k, r.v, r.dbt_valid_from, r[VALID_TO]) for r in h2.collect())
    assert got == [("a", 1, t0, t1), ("a", 2, t1, None), ("b", 1, t0, None), ("c", 1, t1, None),
                   ("d", 1, t0, dt.datetime(2024, 1, 3))]
    # without hard delete the missing key stays open
    h2b = snapshot_apply(h1, run2, ["k"], "u")
    assert [r[VALID_TO] for r in h2b.where("k = 'd'").collect()] == [None]


def test_snapshot_apply_twice_is_idempotent(spark):
    t0 = dt.datetime(2024, 1, 1)
    src = snap_frame(spark, [("a", 1, t0), ("b", 2, t0)])
    h1 = snapshot_apply(None, src, ["k"], "u")
    h2 = snapshot_apply(h1, src, ["k"], "u")
    assert sorted(h1.collect()) == sorted(h2.collect())


def test_exposure_ratio_and_available(spark):
    df = spark.createDataFrame([(None,), (Decimal("0.00"),), (Decimal("100.00"),)], "lim decimal(18,2)") \
        .withColumn("bal", F.lit(Decimal("-25.00")).cast("decimal(18,2)"))
    lim, bal = F.col("lim"), F.col("bal")
    out = df.select(F.when(lim.isNotNull() & (lim > 0), ratio(F.abs(bal), lim)).alias("u"),
                    F.when(lim.isNotNull(), lim - bal).alias("a")).collect()
    assert [r.u for r in out] == [None, None, 0.25]
    assert [None if r.a is None else float(r.a) for r in out] == [None, 25.0, 125.0]


def test_ratio_rounds_half_up_on_exact_value(spark):
    df = spark.createDataFrame([(Decimal("1.25"), Decimal("5000.00"))], "n decimal(18,2), d decimal(18,2)")
    assert df.select(ratio("n", "d").alias("r")).first().r == 0.0003


def test_signed_amounts(spark):
    df = spark.createDataFrame([("DEBIT", Decimal("5")), ("CREDIT", Decimal("-5")), ("REFUND", Decimal("7"))],
                               "t string, a decimal(18,2)")
    out = df.select(signed_amount("a", "t", "DEBIT").alias("s")).collect()
    assert [float(r.s) for r in out] == [-5.0, 5.0, 7.0]


def test_business_date_cutoff(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 3, 0),), (dt.datetime(2024, 1, 10, 5, 0),)],
                               "ts timestamp_ntz")
    out = df.select(cal.business_date("ts", "UTC", 4).alias("b")).collect()
    assert [r.b for r in out] == [dt.date(2024, 1, 9), dt.date(2024, 1, 10)]


def test_calendar_business_days(spark):
    c = cal.dim_calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 8),
                         spark.createDataFrame([(dt.date(2024, 1, 1),)], "holiday_date date"))
    rows = {r.cal_date: r for r in c.collect()}
    assert len(rows) == 7  # end date exclusive
    assert rows[dt.date(2024, 1, 1)].is_holiday and not rows[dt.date(2024, 1, 1)].is_business_day
    assert rows[dt.date(2024, 1, 6)].is_weekend and rows[dt.date(2024, 1, 6)].day_of_week == 7
    assert rows[dt.date(2024, 1, 7)].day_of_week == 1 and rows[dt.date(2024, 1, 7)].day_name == "Sunday"
    dates = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    r = cal.date_calculations(dates, "d", c, offset=2, lookback_days=3).first()
    assert r.previous_business_date == dt.date(2024, 1, 5)
    assert r.business_date_offset == dt.date(2024, 1, 4)   # 1 = Jan 5, 2 = Jan 4
    assert r.history_start_date == dt.date(2024, 1, 3)      # Jan 3, 4, 5


def test_range_overlap(spark):
    ok = spark.createDataFrame([("p", 1, 5), ("p", 5, 9)], "k string, lo int, hi int")
    bad = spark.createDataFrame([("p", 1, 6), ("p", 5, 9)], "k string, lo int, hi int")
    assert q.no_overlapping_ranges(ok, "k", "lo", "hi").count() == 0
    assert q.no_overlapping_ranges(bad, "k", "lo", "hi").count() == 1


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (None, "Z")], "id int, s string")
    assert q.not_null(df, "id").count() == 1
    assert q.unique(df, "id").collect()[0].n_records == 2
    assert q.accepted_values(df, "s", ["A", "B"]).count() == 1
    parents = spark.createDataFrame([(1,)], "id int")
    assert q.relationships(df, "id", parents, "id").count() == 0  # null keys ignored
    assert q.expression_is_true(df, "id > 0").count() == 0       # null is not a failure
    nc = {r.column_name: r.null_count for r in q.null_counts(df).collect()}
    assert nc == {"id": 1, "s": 0}
    s = {r.check_name: r.status for r in q.check_summary({"nn": q.not_null(df, "s"),
                                                          "u": q.unique(df, "id")}).collect()}
    assert s == {"nn": "pass", "u": "fail"}


def test_require_columns_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2)], "Order_ID int, amount int")
    q.require_columns(df, ["order_id", "AMOUNT"])
    with pytest.raises(q.MissingColumnsError, match="customer_id"):
        q.require_columns(df, ["order_id", "customer_id"], "fct_orders")


def test_surrogate_key_matches_sql_text(spark):
    import duckdb
    from ledgerflow.functions.keys import surrogate_key_sql
    df = spark.createDataFrame([(1, None, dt.date(2001, 1, 1))], "a long, b string, c date")
    got = df.select(surrogate_key("a", "b", "c").alias("k")).first().k
    want = duckdb.sql("select " + surrogate_key_sql("1::bigint", "null::varchar", "date '2001-01-01'")).fetchall()[0][0]
    assert got == want


def test_chunked_version_chain_equals_plain(spark):
    from ledgerflow.operators.scd2 import close_versions, close_versions_chunked
    rows = [("a", dt.datetime(2024, m, d)) for m in (1, 2, 4) for d in (1, 15, 28)] + \
           [("b", dt.datetime(2024, 3, 3))]
    df = spark.createDataFrame(rows, "k string, f timestamp_ntz")
    plain = sorted(close_versions(df, ["k"], "f", "t").collect())
    chunked = sorted(close_versions_chunked(df, ["k"], "f", "t", unit="month").select("k", "f", "t").collect())
    assert plain == chunked
    assert [r.t for r in plain if r.k == "b"] == [None]


def test_spine_takes_its_partitions_from_the_argument_or_the_session(spark):
    from ledgerflow.operators.balances import account_day_spine
    acc = spark.createDataFrame([(i, dt.date(2024, 1, 1)) for i in range(50)], "account_id long, account_open_date date")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = lambda **kw: (account_day_spine(acc, "account_open_date", dt.date(2024, 1, 10), **kw)
                          .selectExpr("spark_partition_id() as p", "account_id").distinct().groupBy("p").count().count())
        assert n(partitions=3) == 3
        assert n() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_safe_cast_returns_null_instead_of_raising(spark):
    from ledgerflow.functions.casts import safe_cast
    df = spark.createDataFrame([("12.50",), ("n/a",), (None,)], "s string")
    out = [r.v for r in df.select(safe_cast("s", "decimal(18,2)").alias("v")).collect()]
    assert out == [Decimal("12.50"), None, None]
    with pytest.raises(Exception):
        df.select(F.col("s").cast("decimal(18,2)")).collect()


def test_business_date_in_local_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 23, 30),), (dt.datetime(2024, 7, 2, 4, 30),)],
                               "ts timestamp_ntz")
    out = df.select(cal.business_date("ts", "Europe/London", 4).alias("b")).collect()
    # 00:30 BST on 2 July is before the 04:00 cutoff -> 1 July; 05:30 BST -> 2 July
    assert [r.b for r in out] == [dt.date(2024, 7, 1), dt.date(2024, 7, 2)]


def test_orphans_are_counted_by_key_before_the_join(spark):
    """36 rows of two keys and a null: the anti join meets a row for each key and task, not the rows."""
    from pyspark.sql import Observation
    rows = [("CASE",)] * 20 + [("GONE",)] * 15 + [(None,)]
    child = spark.createDataFrame(rows, "k string").repartition(2)
    parent = spark.createDataFrame([("CASE",), ("CASE",)], "p string")
    assert q.orphan_count(child, "k", parent, "p").collect() == [(15,)]
    assert q.relationships(child, "k", parent, "p").count() == 15
    assert q.orphan_count(child.where("k = 'CASE'"), "k", parent, "p").collect() == [(0,)]
    met = Observation()
    by_key = q.relationships(child.groupBy("k").count().observe(met, F.count(F.lit(1)).alias("n")), "k", parent, "p")
    by_key.collect()
    assert met.get["n"] == 3
    plan = q.orphan_count(child, "k", parent, "p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftAnti") < plan.rindex("Aggregate [k")
