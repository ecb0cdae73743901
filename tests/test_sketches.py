from pyspark.sql import functions as F

from conftest import SF_CHECK
from ledgerflow.operators import sketches as sk
from ledgerflow.sources.adapters import Tables
from ledgerflow.sources.files import scratch_dir


def close(rows, share=0.03):
    assert rows
    for r in rows:
        assert abs(r.estimate - r.exact) <= max(1, share * r.exact), r


def test_months_of_spending_merge_across_increments(spark):
    """R-5's distinct transactions by area: monthly sketches of two increments that overlap."""
    t = Tables(spark, SF_CHECK).retail_daily_transactions().withColumn("month", F.trunc("transaction_date", "month"))
    path, keys = scratch_dir(spark, "spending_sketches"), ["store_area", "month"]
    for run, part in (("r1", "transaction_date < '1997-06-15'"), ("r2", "transaction_date >= '1997-05-01'"), ("r2", "transaction_date >= '1997-05-01'")):
        sk.store_sketches(sk.distinct_sketches(t.where(part), keys, "transaction_id"), path, run)
    for by in (["store_area"], keys, ["month"]):
        exact = t.groupBy(*by).agg(F.countDistinct("transaction_id").alias("exact"))
        close(sk.stored_estimates(spark, path, by, "estimate").join(exact, by).collect())
        assert sk.stored_estimates(spark, path, by, "estimate").count() == exact.count()


def test_accounts_of_customers_by_month(spark):
    """D-7's distinct accounts, by branch and opening month and merged over months."""
    a = Tables(spark, SF_CHECK).stg_accounts().withColumn("month", F.trunc("account_open_date", "month"))
    by_month = sk.distinct_sketches(a, ["branch_id", "month"], "account_id")
    exact = a.groupBy("branch_id").agg(F.countDistinct("account_id").alias("exact"))
    close(sk.estimates(sk.merge_sketches(by_month, ["branch_id"]), "estimate").join(exact, "branch_id").collect())


def test_large_counts_and_nulls(spark):
    rows = spark.range(200_000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 60_000).alias("v"))
    exact = rows.groupBy("k").agg(F.countDistinct("v").alias("exact"))
    close(sk.estimates(sk.distinct_sketches(rows, ["k"], "v"), "estimate").join(exact, "k").collect())
    assert sk.estimates(sk.distinct_sketches(rows.where("v is null"), ["k"], "v"), "n").agg(F.max("n")).first()[0] == 0
    assert sk.distinct_sketches(rows.limit(0), ["k"], "v").count() == 0


def test_load_times_come_from_the_files(spark):
    import datetime as dt
    import os
    from ledgerflow.operators.quality import load_freshness
    root = scratch_dir(spark, "freshness")
    at = dt.datetime(2024, 1, 10, 12, tzinfo=dt.timezone.utc).timestamp()
    for name, hours in (("new", 1), ("old", 5), ("stale", 50)):
        spark.range(3).write.parquet(f"{root}/{name}")
        for d, _, fs in os.walk(f"{root}/{name}".removeprefix("file:")):
            for f in fs:
                os.utime(os.path.join(d, f), (at - 3600 * (hours + 30),) * 2)
        newest = next(os.path.join(d, f) for d, _, fs in os.walk(f"{root}/{name}".removeprefix("file:")) for f in sorted(fs) if f.startswith("part"))
        os.utime(newest, (at - 3600 * hours,) * 2)
    got = load_freshness(spark, [(n, f"{root}/{n}", 2, 12) for n in ("new", "old", "stale", "none")], "2024-01-10 12:00:00").collect()
    assert [(r.source, r.age_hours, r.status) for r in got] == [("new", 1.0, "pass"), ("old", 5.0, "warn"), ("stale", 50.0, "error"), ("none", None, "missing")]
