"""Sums of MONEY in two longs, and the IFRS reports over amounts that need both."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.functions.money import MONEY, MONEY_SUM, parts_total, sum_parts
from ledgerflow.plans import reports
from ledgerflow.sources.adapters import Tables
from tools.check_oracle import TABLES, norm

BIG = Decimal("9999999999999999.99")


@pytest.mark.parametrize("amounts", [
    [BIG] * 2000, [-BIG] * 1500, [BIG, -BIG, Decimal("-0.01")], [Decimal("999999.99"), Decimal("0.01")],
    [Decimal("-1000000.00"), Decimal("999999.99")], [None, None], [None, Decimal("5.25")], [Decimal("1000000.00")]])
def test_the_parts_sum_to_the_decimal_sum(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], f"a {MONEY}")
    got = df.agg(*sum_parts("a", "a"), F.sum("a").cast(MONEY_SUM).alias("want")).select(parts_total("a").alias("got"), "want")
    assert dict(got.dtypes) == {"got": MONEY_SUM, "want": MONEY_SUM}
    row = got.first()
    assert row.got == row.want


@pytest.fixture
def odd(tmp_path):
    """Policies with prices over a million, equal ids, null keys, months and prices."""
    day = dt.datetime(2001, 1, 20)
    lines = [(p, (p or 0) % 3, k, n, q, price, 0.0, 0.0, flag, "F" if n % 2 else "O", None if p == 5 and n == 2 else day + dt.timedelta(days=9 * n))
             for p in (1, 2, 5, None) for k, (n, flag) in enumerate([(1, "R"), (2, "N"), (3, "A"), (3, "A"), (4, "R"), (4, "R")])
             for q, price in [(7.0, 123456789012.34), (40000.0, 5.25), (1.0, None)]]
    orders = [(p, 10 + (p or 0), s, 3e5, dt.datetime(2001, 1, 2), "1-URGENT") for p, s in [(1, "O"), (2, "P"), (5, "F"), (6, "F"), (None, "O")]]
    con = duckdb.connect()
    for t in set(TABLES) - {"lineitem", "orders"}:  # named by statements the report does not use
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    con.execute("""create table lineitem (l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag varchar, l_linestatus varchar, l_shipdate timestamp)""")
    con.execute("create table orders (o_orderkey bigint, o_custkey bigint, o_orderstatus varchar, o_totalprice double, o_orderdate timestamp, o_orderpriority varchar)")
    con.executemany(f"insert into lineitem values ({','.join('?' * 11)})", lines)
    con.executemany(f"insert into orders values ({','.join('?' * 6)})", orders)
    for t in ("lineitem", "orders"):
        con.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
    return con, str(tmp_path)


@pytest.mark.parametrize("name", ["rpt_ifrs_balances_literal"])
def test_report_of_odd_rows_matches_the_oracle(spark, odd, name):
    con, path = odd
    got = E.queries()[name](spark, path)
    cur = con.sql(E.oracle_sql()[name])
    want = sorted((repr({c: norm(v) for c, v in zip(cur.columns, r)}) for r in cur.fetchall()))
    assert want and sorted(repr({c: norm(r[c]) for c in cur.columns}) for r in got.collect()) == want
    assert any(r.claim_reserves > 10**6 for r in got.collect())


def test_the_report_sorts_no_snapshots_and_builds_ids_once_a_line(spark, odd):
    df = reports.rpt_ifrs_balances_literal(Tables(spark, odd[1]))
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [i for i, line in enumerate(lines) if "Generate explode([" in line]  # rows made of a line
    assert made
    for i in made:
        scan = next(j for j in range(i, len(lines)) if "Relation" in lines[j])
        assert any("concat_ws" in line for line in lines[i + 1:scan])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = reports.reserves_with_policy(Tables(spark, odd[1]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in physical and "Sort [" not in physical
