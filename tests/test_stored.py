"""Tables on storage: merge by key, histories, column changes, and the pipeline over them."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.operators import stored
from ledgerflow.operators.incremental import DuplicateKeyError
from ledgerflow.plans import pipeline, snapshots
from ledgerflow.sources.adapters import Tables
from ledgerflow.sources.files import absent, scratch_dir


def files(path):
    root = pathlib.Path(path.removeprefix("file:"))
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- merge ------------------------------------------------------------------------------
def test_merges_equal_a_dictionary(spark):
    path, rnd, want = f"{scratch_dir(spark, 'merge')}/t", random.Random(2), {}
    schema = "k long, part string, v int"
    keys = [(None, "a"), *[(i, p) for i in range(40) for p in ("a", None)]]
    for step in range(4):
        new = {k: rnd.randrange(100) for k in rnd.sample(keys, 30)}
        gone = [k for k in rnd.sample(keys, 6) if k not in new] if step else []
        done = stored.merge_stored(spark, path, spark.createDataFrame([(*k, v) for k, v in new.items()], schema), ["k", "part"], 7,
                                   spark.createDataFrame(gone, "k long, part string") if gone else None)
        want |= new
        for k in gone:
            want.pop(k, None)
        assert done.rows == 30 and rows(stored.read_merged(spark, path)) == sorted(((*k, v) for k, v in want.items()), key=repr)


def test_only_touched_buckets_are_rewritten(spark):
    path = f"{scratch_dir(spark, 'touched')}/t"
    stored.merge_stored(spark, path, spark.range(1000).withColumn("v", F.lit(0)), ["id"], 16)
    before = files(path)
    done = stored.merge_stored(spark, path, spark.createDataFrame([(3, 1), (2000, 1)], "id long, v int"), ["id"])
    after = files(path)
    touched = {r[0] for r in spark.createDataFrame([(3,), (2000,)], "id long").select(stored.key_bucket(["id"], 16)).collect()}
    assert done == (2, len(touched))
    untouched = {p: at for p, at in before.items() if not any(p.startswith(f"{stored.BUCKET}={b}/") for b in touched)}
    assert untouched and all(after[p] == at for p, at in untouched.items())
    assert not {p for p in before if p not in untouched} & set(after)
    table = stored.read_merged(spark, path)
    assert table.count() == 1001 and sorted(rows(table.where("v = 1"))) == [(3, 1), (2000, 1)]
    # the plan of the stored side lists the touched buckets alone
    assert stored.merge_stored(spark, path, table.limit(0), ["id"]) == (0, 0) and files(path) == after


def test_a_bucket_may_be_emptied(spark):
    path = f"{scratch_dir(spark, 'emptied')}/t"
    stored.merge_stored(spark, path, spark.range(6).withColumn("v", F.lit(0)), ["id"], 3)
    stored.merge_stored(spark, path, spark.createDataFrame([], "id long, v int"), ["id"], deletes=spark.range(6))
    assert files(path) == {} or stored.read_merged(spark, path).count() == 0


def test_repeated_keys_are_refused_and_leave_the_table(spark):
    path = f"{scratch_dir(spark, 'repeated')}/t"
    stored.merge_stored(spark, path, spark.range(5).withColumn("v", F.lit(0)), ["id"], 2)
    before = files(path)
    with pytest.raises(DuplicateKeyError):
        stored.merge_stored(spark, path, spark.createDataFrame([(1, 1), (1, 2)], "id long, v int"), ["id"])
    assert files(path) == before
    assert stored.merge_stored(spark, path, spark.createDataFrame([(1, 3)], "id long, v int"), ["id"]).rows == 1


@pytest.mark.parametrize("step", ["before it counts", "while it is applied"])
def test_a_merge_that_fails_is_finished_or_forgotten(spark, monkeypatch, step):
    path = f"{scratch_dir(spark, 'failing')}/t"
    stored.merge_stored(spark, path, spark.range(50).withColumn("v", F.lit(0)), ["id"], 4)
    real = stored._apply

    def fail(s, p):
        if step == "before it counts":
            stored.discard(s, f"{stored._staged(p)}/touched")  # as if the marker had never been written
        else:
            stored.discard(s, f"{p}/{stored.BUCKET}=1")  # a bucket was removed and its new files did not come
        raise RuntimeError("lost")

    monkeypatch.setattr(stored, "_apply", fail)
    updates = spark.range(50).withColumn("v", F.lit(1))
    with pytest.raises(RuntimeError):
        stored.merge_stored(spark, path, updates, ["id"])
    monkeypatch.setattr(stored, "_apply", real)
    stored.recover(spark, path)
    assert rows(stored.read_merged(spark, path)) == sorted(((i, int(step == "while it is applied")) for i in range(50)), key=repr)
    assert absent(spark, stored._staged(path))
    stored.merge_stored(spark, path, updates, ["id"])
    assert sorted(rows(stored.read_merged(spark, path))) == [(i, 1) for i in range(50)]


# ---- history ----------------------------------------------------------------------------
def _state(spark, values):
    return spark.createDataFrame([(k, v, dt.datetime(2024, m, 1)) for k, v, m in values], "k long, v string, changed timestamp_ntz")


def test_a_run_writes_open_rows_and_its_own_closures(spark):
    path = f"{scratch_dir(spark, 'history')}/t"
    states = [("2024-02-01 00:00:00", [(k, "a", 1) for k in range(20)]),
              ("2024-04-01 00:00:00", [(k, "b" if k == 3 else "a", 3 if k == 3 else 1) for k in range(20) if k != 7]),
              ("2024-05-15 00:00:00", [(k, "b" if k == 3 else "a", 3 if k == 3 else 1) for k in range(21) if k not in (7, 8)])]
    whole = None
    for at, values in states:
        source = _state(spark, values)
        got = stored.snapshot_store(spark, path, source, ["k"], "changed", at, hard_delete=True)
        whole = stored.snapshot_apply(whole, source, ["k"], "changed", F.lit(at).cast("timestamp_ntz"), True)
        assert rows(got.select(*whole.columns)) == rows(whole)
    written = {run: spark.read.parquet(f"{path}/snapshot_run={run}").groupBy("version_state").count().collect() for run in ("20240401000000", "20240515000000")}
    assert {r.version_state: r["count"] for r in written["20240401000000"]} == {"open": 19, "closed": 2}
    assert {r.version_state: r["count"] for r in written["20240515000000"]} == {"open": 19, "closed": 1}
    assert not any("20240201000000/version_state=open" in p for p in files(path))  # two runs old
    assert {p.split("/")[2] for p in files(path) if "version_state=closed" in p} == {"closed_month=2024-03", "closed_month=2024-04", "closed_month=2024-05"}


def test_the_last_run_repeats_and_an_earlier_one_is_refused(spark):
    path = f"{scratch_dir(spark, 'repeat')}/t"
    stored.snapshot_store(spark, path, _state(spark, [(1, "a", 1), (2, "a", 1)]), ["k"], "changed", "2024-02-01")
    stored.snapshot_store(spark, path, _state(spark, [(1, "wrong", 2)]), ["k"], "changed", "2024-03-01", True)
    kept = {p: at for p, at in files(path).items() if "20240201" in p}
    got = stored.snapshot_store(spark, path, _state(spark, [(1, "b", 2), (2, "a", 1)]), ["k"], "changed", "2024-03-01", True)
    assert sorted((r.k, r.v, r.dbt_valid_to is None) for r in got.collect()) == [(1, "a", False), (1, "b", True), (2, "a", True)]
    assert all(files(path)[p] == at for p, at in kept.items())
    with pytest.raises(stored.RunOrderError):
        stored.snapshot_store(spark, path, _state(spark, [(1, "a", 1)]), ["k"], "changed", "2024-02-15")


def test_an_unfinished_run_is_not_read(spark, monkeypatch):
    path = f"{scratch_dir(spark, 'unfinished')}/t"
    stored.snapshot_store(spark, path, _state(spark, [(1, "a", 1)]), ["k"], "changed", "2024-02-01")
    spark.range(1).selectExpr("9L as k").write.parquet(f"{path}/snapshot_run=20240301/version_state=open/closed_month=none")  # written, never marked
    assert [r.k for r in stored.read_history(spark, path).collect()] == [1]


def test_stored_order_history_equals_the_replay_with_hard_deletes(spark):
    wh = scratch_dir(spark, "orders_history")
    for at in (*snapshots.ORDER_RUNS, snapshots.ORDER_RUNS[-1]):
        out = pipeline.snapshot_run(spark, SF_SMALL, wh, "snap_orders", at)
    direct = E.queries()["snap_orders"](spark, SF_SMALL)
    assert rows(out.select(*direct.columns)) == rows(direct)
    assert out.where("dbt_valid_to is not null").count() > 0


# ---- columns ----------------------------------------------------------------------------
def _append(spark, path, df):
    stored.register_columns(spark, path, df).write.mode("append").parquet(path)


def test_new_and_dropped_columns_follow_the_latest_write(spark):
    path = f"{scratch_dir(spark, 'columns')}/t"
    _append(spark, path, spark.createDataFrame([(1, "x", 5)], "k long, old string, v int"))
    _append(spark, path, spark.createDataFrame([(2, 6, 0.5)], "k long, v int, fresh double"))
    got = stored.read_synced(spark, path)
    assert got.columns == ["k", "v", "fresh"] and rows(got) == [(1, 5, None), (2, 6, 0.5)]
    _append(spark, path, spark.createDataFrame([(3, 7, 7)], "k long, old int, v int"))  # another column of a name once dropped
    got = stored.read_synced(spark, path)
    assert rows(got.select("k", "old", "v")) == [(1, None, 5), (2, None, 6), (3, 7, 7)] and "fresh" not in got.columns
    assert stored.registered(spark, path)[0] == 3
    _append(spark, path, spark.createDataFrame([(4, 8, 8)], "k long, old int, v int"))
    assert stored.registered(spark, path)[0] == 3  # nothing new


@pytest.mark.parametrize("schema,name", [("k int, v int", "k"), ("k long, v bigint", "v"), ("k long, V int", "V"), ("k string, v int", "k")])
def test_changed_types_and_spellings_are_refused_by_name(spark, schema, name):
    path = f"{scratch_dir(spark, 'refused')}/t"
    _append(spark, path, spark.createDataFrame([(1, 5)], "k long, v int"))
    before = files(path)
    with pytest.raises(stored.SchemaChangeError, match=f"{name}:"):
        _append(spark, path, spark.createDataFrame([], schema))
    assert files(path) == before and stored.registered(spark, path)[0] == 1


# ---- the pipeline over them ---------------------------------------------------------------
def _same(spark, wh, name, columns=None):
    direct = E.queries()[name](spark, SF_SMALL)
    path = f"{wh}/{name}"
    table = stored.read_merged(spark, path) if name in pipeline.MERGED else pipeline._read(spark, path, name)
    assert rows(table.select(*direct.columns)) == rows(direct), name


def test_merged_models_take_increments(spark, monkeypatch):
    monkeypatch.setattr(stored, "BUCKETS", 64)
    wh, models = scratch_dir(spark, "merged"), ["fct_orders", "dim_customers", "customer_spending_analysis"]
    cut = F.lit("2001-06-20 00:00:00").cast("timestamp_ntz")
    first = Tables(spark, SF_SMALL).restrict(stg_orders=F.col("updated_at") < cut, retail_daily_transactions=F.col("last_updated_at") < cut,
                                             stg_customers=F.col("customer_id") % 10 != 3)
    pipeline.run(spark, SF_SMALL, wh, models, tables=first)
    before = {m: files(f"{wh}/{m}") for m in models}
    log = {r.model_name: r.row_count for r in pipeline.run(spark, SF_SMALL, wh, models).collect()}
    for m in models:
        _same(spark, wh, m)
        assert 0 < log[m] < stored.read_merged(spark, f"{wh}/{m}").count()  # what changed, not the whole model
    late = {p: at for p, at in before["fct_orders"].items() if files(f"{wh}/fct_orders").get(p) == at}
    assert late  # buckets without a changed order keep their files
    pipeline.run(spark, SF_SMALL, wh, models, full_refresh=True)
    for m in models:
        _same(spark, wh, m)


def test_months_that_lost_their_rows_leave(spark):
    """A corrected source has no rows in a month of the window that the table holds."""
    wh = scratch_dir(spark, "lost_months")
    pipeline.run(spark, SF_SMALL, wh, ["fct_claims"])
    last = spark.read.parquet(f"{wh}/fct_claims").agg(F.max("claim_reported_date")).first()[0]
    month = last.strftime("%Y-%m")
    corrected = Tables(spark, SF_SMALL).restrict(stg_claims=F.date_format("claim_reported_date", "yyyy-MM") != month)
    pipeline.run(spark, SF_SMALL, wh, ["fct_claims"], tables=corrected)
    direct = E.queries()["fct_claims"](spark, SF_SMALL).where(F.date_format("claim_reported_date", "yyyy-MM") != month)
    assert rows(spark.read.parquet(f"{wh}/fct_claims").select(*direct.columns)) == rows(direct)


def test_a_model_with_changed_columns_equals_the_full_build(spark, monkeypatch):
    """The stored table has an extra column and lacks one; the increment brings the present set."""
    from ledgerflow.plans import facts
    wh, name = scratch_dir(spark, "synced"), "fct_claim_reserve_snapshots"
    cut = F.lit("2001-06-20").cast("date")
    older = Tables(spark, SF_SMALL).restrict(stg_claim_reserves_snapshots=F.col("reserve_snapshot_date") <= cut)
    real = pipeline._full
    monkeypatch.setattr(pipeline, "_full", lambda n, t, a: facts.fct_claim_reserve_snapshots(t).drop("customer_id").withColumn("load_batch", F.lit("v1")))
    pipeline.run(spark, SF_SMALL, wh, [name], tables=older)
    monkeypatch.setattr(pipeline, "_full", real)
    old = files(f"{wh}/{name}")
    pipeline.run(spark, SF_SMALL, wh, [name])
    got = pipeline._read(spark, f"{wh}/{name}", name).drop(pipeline.MONTH)
    direct = E.queries()[name](spark, SF_SMALL)
    start = "2001-06-01"
    assert set(got.columns) == set(direct.columns)
    for part in (f"snapshot_date >= '{start}'", f"snapshot_date < '{start}'"):
        want = direct.where(part)
        if "<" in part:  # rows of the older column set
            want = want.withColumn("customer_id", F.lit(None).cast(direct.schema["customer_id"].dataType))
        assert rows(got.where(part).select(*direct.columns)) == rows(want.select(*direct.columns))
    assert all(files(f"{wh}/{name}").get(p) == at for p, at in old.items() if p < f"{pipeline.MONTH}=2001-04")
