"""SCD2 properties on the registered snapshot jobs (sf0.001): versions of a
key never overlap, each key has at most one open version, and every closed
version ends where the next one starts unless the key was deleted."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.operators import quality as q

KEYS = {"snap_customer_address": "customer_id", "snap_employee_role": "employee_id",
        "snap_product_price": "product_code", "snap_orders": "order_id", "snap_from_change_log": "customer_id"}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_snapshot_history_is_well_formed(spark, name):
    key = KEYS[name]
    h = E.queries()[name](spark, SF_SMALL)
    assert q.no_overlapping_ranges(h, key, "dbt_valid_from",
                                   "coalesce(dbt_valid_to, timestamp_ntz '2999-12-31 00:00:00')").count() == 0
    open_per_key = h.where(F.col("dbt_valid_to").isNull()).groupBy(key).count()
    assert open_per_key.where("count > 1").count() == 0
    assert h.where(F.col("dbt_valid_to") <= F.col("dbt_valid_from")).count() == 0


def test_hard_deleted_keys_have_no_open_version(spark):
    d = E.queries()["snap_hard_delete"](spark, SF_SMALL)
    assert d.count() > 0
    assert d.where(F.col("dbt_valid_to").isNull()).count() == 0


def test_long_replay_cuts_lineage_and_matches(spark):
    import datetime as dt
    from ledgerflow.plans.snapshots import replay
    runs = []
    for i in range(6):
        ts = dt.datetime(2024, 1, 1 + i)
        rows = [("a", i, ts), ("b", 0, dt.datetime(2024, 1, 1))]
        runs.append((spark.createDataFrame(rows, "k string, v int, u timestamp_ntz"), f"2024-01-0{1 + i} 12:00:00"))
    plain = replay(runs, ["k"], "u", checkpoint_every=0)
    cut = replay(runs, ["k"], "u", checkpoint_every=2)
    assert sorted(plain.collect()) == sorted(cut.collect())
    assert cut.where("k = 'a'").count() == 6
