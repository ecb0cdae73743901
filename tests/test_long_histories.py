"""Keys with very long histories: the two-level balance and the run compression by chunks."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators.balances import daily_balances, daily_balances_by_month
from ledgerflow.operators.scd2 import compress_runs, compress_runs_chunked

AS_OF = dt.date(2024, 5, 10)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def both(spark, accounts, amounts):
    acc = spark.createDataFrame(accounts, "account_id long, account_open_date date, opening_balance decimal(18,2), currency_code string")
    amt = spark.createDataFrame(amounts, "account_id long, balance_date date, daily_net_amount decimal(18,2)")
    a, b = daily_balances(acc, amt, AS_OF), daily_balances_by_month(acc, amt, AS_OF)
    assert a.dtypes == b.dtypes
    return rows(a), rows(b)


def test_two_levels_equal_one(spark):
    d = lambda *a: dt.date(*a)
    accounts = [(1, d(2024, 1, 31), Decimal("10.00"), "GBP"), (2, d(2024, 5, 10), Decimal("0.00"), None), (3, d(2024, 5, 11), Decimal("1.00"), "EUR"),
                (4, d(2024, 2, 1), Decimal("-5.50"), "EUR"), (5, d(2024, 3, 1), None, "EUR"), (6, None, Decimal("1.00"), "EUR")]
    amounts = [(1, d(2024, 1, 30), Decimal("99.00")), (1, d(2024, 1, 31), Decimal("1.25")), (1, d(2024, 2, 29), Decimal("-3.00")), (1, d(2024, 3, 1), Decimal("7.00")),
               (1, d(2024, 5, 11), Decimal("50.00")), (2, d(2024, 5, 10), Decimal("4.00")), (4, d(2024, 2, 1), None), (4, d(2024, 4, 30), Decimal("2.00")),
               (9, d(2024, 4, 1), Decimal("8.00")), (5, d(2024, 3, 9), Decimal("1.00"))]
    one, two = both(spark, accounts, amounts)
    assert one == two and len(one) > 250
    assert both(spark, [], []) == ([], [])


def test_a_century_of_one_account_uses_many_tasks(spark):
    """No partition holds more than a few of its months."""
    opened = dt.date(1924, 1, 1)
    amounts = [(1, opened + dt.timedelta(days=37 * i), Decimal(i % 7 - 3)) for i in range(900)]
    acc = spark.createDataFrame([(1, opened, Decimal("1.00"), "GBP")], "account_id long, account_open_date date, opening_balance decimal(18,2), currency_code string")
    amt = spark.createDataFrame(amounts, "account_id long, balance_date date, daily_net_amount decimal(18,2)")
    two = daily_balances_by_month(acc, amt, AS_OF, partitions=64)
    sizes = [r["count"] for r in two.groupBy(F.spark_partition_id()).count().collect()]
    total = (AS_OF - opened).days + 1
    assert sum(sizes) == total and len(sizes) > 48 and max(sizes) < total / 16
    assert rows(two) == rows(daily_balances(acc, amt, AS_OF))


DAYS = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 130), st.sampled_from([1, 1, 1, 2, None])), max_size=60, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=15, deadline=None)
@given(DAYS)
def test_chunked_runs_equal_plain_runs(spark, days):
    data = [(k if k else None, dt.date(2024, 1, 20) + dt.timedelta(days=d), v, str(v)) for k, d, v in days]
    df = spark.createDataFrame(data, "k long, day date, v int, w string")
    for values in (["v"], ["v", "w"]):
        assert rows(compress_runs_chunked(df, ["k"], "day", values)) == rows(compress_runs(df, ["k"], "day", values))


def test_a_run_over_many_chunks_and_gaps(spark):
    start = dt.date(2020, 1, 15)
    values = [5] * 400 + [6] + [5] * 100 + [7] * 31 + [5] * 31
    data = [(1, start + dt.timedelta(days=i), v) for i, v in enumerate(values) if not 100 <= i < 170]  # two months without rows
    df = spark.createDataFrame(data, "k long, day date, v int")
    got = rows(compress_runs_chunked(df, ["k"], "day", ["v"]))
    assert got == rows(compress_runs(df, ["k"], "day", ["v"])) and len(got) == 5
