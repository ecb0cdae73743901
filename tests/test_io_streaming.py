import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.audit import RunContext, write_with_audit
from ledgerflow.sources import files
from ledgerflow.streaming import jobs as streaming


def test_ledger_reads_each_file_once(spark):
    root = files.scratch_dir(spark, "test_ledger")
    df = spark.range(100).select(F.col("id").alias("k"))
    files.write_staging_csv(df.where("k < 50"), f"{root}/raw/a")
    assert files.ingest_new_files(spark, f"{root}/raw", f"{root}/ledger", "k bigint", f"{root}/t", "1") > 0
    files.write_staging_csv(df.where("k >= 50"), f"{root}/raw/b")
    files.write_staging_csv(df, f"{root}/raw/Processed/old")  # archived copies are never read
    files.ingest_new_files(spark, f"{root}/raw", f"{root}/ledger", "k bigint", f"{root}/t", "2")
    assert files.ingest_new_files(spark, f"{root}/raw", f"{root}/ledger", "k bigint", f"{root}/t", "3") == 0
    assert sorted(r.k for r in spark.read.parquet(f"{root}/t").collect()) == list(range(100))


def test_stream_ingest_archives_and_reads_once(spark):
    root = files.scratch_dir(spark, "test_stream")
    df = spark.range(20).select(F.col("id").alias("k"))
    files.write_staging_csv(df.where("k < 10"), f"{root}/in/a")
    streaming.stream_ingest(spark, f"{root}/in/*", "k bigint", f"{root}/t", f"{root}/ck", archive_dir=f"{root}/arch")
    files.write_staging_csv(df.where("k >= 10"), f"{root}/in/b")
    streaming.stream_ingest(spark, f"{root}/in/*", "k bigint", f"{root}/t", f"{root}/ck", archive_dir=f"{root}/arch")
    assert sorted(r.k for r in spark.read.parquet(f"{root}/t").collect()) == list(range(20))


def test_velocity_stream_matches_batch_for_every_day(spark):
    root = files.scratch_dir(spark, "test_velocity")
    base = dt.datetime(2024, 1, 1, 10)
    rows = [(1, 1, base), (2, 1, base + dt.timedelta(hours=1)), (3, 2, base),
            (4, 1, base + dt.timedelta(days=5)), (5, 1, base + dt.timedelta(days=5, hours=1))]
    spark.createDataFrame(rows, "transaction_id long, account_id long, transaction_timestamp timestamp_ntz") \
        .write.parquet(f"{root}/src")
    out = streaming.velocity_alerts(spark, f"{root}/src", "transaction_id long, account_id long, "
                                    "transaction_timestamp timestamp_ntz", f"{root}/out", f"{root}/ck")
    assert sorted((r.account_id, r.transaction_date, r.txn_count) for r in out.collect()) == [
        (1, dt.date(2024, 1, 1), 2), (1, dt.date(2024, 1, 6), 2)]


def test_write_with_audit_counts_during_write(spark):
    root = files.scratch_dir(spark, "test_audit")
    run = RunContext(dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 6), "r1", "test")
    n = write_with_audit(spark.range(42), f"{root}/t", "m", run, f"{root}/log")
    assert n == 42
    assert spark.read.parquet(f"{root}/log").first().row_count == 42


def test_meter_output_one_file_per_series_sorted(spark):
    import datetime as dt
    import glob
    import os
    root = files.scratch_dir(spark, "test_meter_out")
    day = dt.date(2024, 1, 1)
    rows = [(m, q, day + dt.timedelta(days=d), "0", "A") for m in range(20) for q in ("AI", "RI") for d in (2, 0, 1)]
    prof = spark.createDataFrame(rows, "meter_id long, qty string, read_day date, hh_values string, hh_flags string")
    files.write_meter_output(prof, root, "240131")
    seen = {}
    for path in glob.glob(os.path.join(root.removeprefix("file:"), "load_date=240131", "qty=*", "*.csv")):
        qty = path.split("qty=")[1].split("/")[0]
        lines = [ln.split(",") for ln in open(path).read().splitlines() if ln]
        for m, d in {(ln[0], ln[1]) for ln in lines}:
            assert (m, qty) not in seen or seen[(m, qty)] == path  # a series never spans two files
            seen[(m, qty)] = path
        for m in {ln[0] for ln in lines}:
            days = [ln[1] for ln in lines if ln[0] == m]
            assert days == sorted(days)
    assert len(seen) == 40


def test_ingest_survives_a_crash_before_the_ledger(spark, monkeypatch):
    from ledgerflow.sources import files
    root = files.scratch_dir(spark, "crash")
    schema = "k int, v string"
    files.write_staging_csv(spark.createDataFrame([(1, "a"), (2, "b")], schema), f"{root}/raw/one")
    real = files._write_batch

    def crash(rows, path, batch_id, fmt="parquet"):
        if path.endswith("ledger"):
            raise RuntimeError("lost")
        real(rows, path, batch_id, fmt)

    monkeypatch.setattr(files, "_write_batch", crash)
    args = (spark, f"{root}/raw", f"{root}/ledger", schema, f"{root}/table")
    with pytest.raises(RuntimeError):
        files.ingest_new_files(*args, "b1")
    monkeypatch.setattr(files, "_write_batch", real)
    assert files.loaded(spark, f"{root}/table", f"{root}/ledger").count() == 0
    assert files.ingest_new_files(*args, "b2", processed_dir=f"{root}/raw/Processed") > 0
    assert files.ingest_new_files(*args, "b3", processed_dir=f"{root}/raw/Processed") == 0
    assert sorted(map(tuple, files.loaded(spark, f"{root}/table", f"{root}/ledger").collect())) == [(1, "a"), (2, "b")]
    moved = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(f"{root}/raw/Processed/batch_id=b2")
    assert moved.count() == 2  # the raw files themselves


NAMES = ["plain.csv", "a+b.csv", "c d.csv", "e%20f.csv", "g[1].csv", "h{x,y}.csv", "ü é.csv", "q?.csv", "s*.csv", "back\\slash.csv", "100%.csv", "k=v.csv", "#x&y;.csv",
         "sub folder+/plain.csv", "sub folder+/a+b.csv"]


def _put(root, names, value=0):
    import os
    base = root.removeprefix("file:")
    for i, name in enumerate(names):
        os.makedirs(os.path.dirname(f"{base}/{name}"), exist_ok=True)
        with open(f"{base}/{name}", "w", encoding="utf-8") as f:
            f.write(f"k,v\n{value + i},{name.replace(',', ' ')}\n")


def _below(root):
    import os
    base = root.removeprefix("file:")
    return sorted(os.path.relpath(os.path.join(d, f), base) for d, _, fs in os.walk(base) for f in fs if not f.startswith((".", "_")))


def test_files_of_any_name_land_once_and_leave(spark):
    root = files.scratch_dir(spark, "names")
    raw, args = f"{root}/raw", (spark, f"{root}/raw", f"{root}/ledger", "k int, v string", f"{root}/table")
    _put(raw, NAMES)
    kept = {"processed_dir": f"{raw}/Processed", "backup_dir": f"{raw}/Backup"}
    assert files.ingest_new_files(*args, "b1", **kept) == len(NAMES)
    got = files.loaded(spark, f"{root}/table", f"{root}/ledger")
    assert sorted(r.k for r in got.collect()) == list(range(len(NAMES)))
    assert _below(f"{raw}/Processed/batch_id=b1") == sorted(NAMES)  # raw files, names and folders kept
    assert [p for p in _below(raw) if not p.startswith(("Processed/", "Backup/"))] == []
    assert files.ingest_new_files(*args, "b2", **kept) == 0
    backup = spark.read.schema("k int, v string").option("header", True).csv(f"{raw}/Backup/batch_id=b1")
    assert sorted(r.k for r in backup.collect()) == list(range(len(NAMES)))
    _put(raw, ["a+b.csv", "new.csv"], 100)  # a name that came before is another delivery
    assert files.ingest_new_files(*args, "b3", **kept) == 2
    assert sorted(r.k for r in files.loaded(spark, f"{root}/table", f"{root}/ledger").collect()) == [*range(len(NAMES)), 100, 101]
    assert _below(f"{raw}/Processed/batch_id=b3") == ["a+b.csv", "new.csv"]


def test_a_batch_reads_only_its_own_files(spark):
    root = files.scratch_dir(spark, "own")
    args = (spark, f"{root}/raw", f"{root}/ledger", "k int, v string", f"{root}/table")
    _put(f"{root}/raw", [f"{i}.csv" for i in range(7)])
    read = []
    real = files.read_files
    try:
        files.read_files = lambda s, uris, *a: read.append(len(uris)) or real(s, uris, *a)
        sizes = [files.ingest_new_files(*args, f"b{i}", max_files=3) for i in range(4)]
    finally:
        files.read_files = real
    assert sizes == [3, 3, 1, 0] and read == [3, 3, 1]
    assert sorted(r.k for r in files.loaded(spark, f"{root}/table", f"{root}/ledger").collect()) == list(range(7))
    rows = real(spark, [r.file_path for r in files.list_files(spark, f"{root}/raw").where("file_path like '%/2.csv'").collect()], "k int, v string")
    assert len(rows.inputFiles()) == 1 and [r.k for r in rows.collect()] == [2]


@pytest.mark.parametrize("step", ["table", "Backup", "ledger", "after ledger", "half moved"])
def test_a_crash_between_any_two_steps_loses_and_doubles_nothing(spark, monkeypatch, step):
    root = files.scratch_dir(spark, "steps")
    raw, args = f"{root}/raw", (spark, f"{root}/raw", f"{root}/ledger", "k int, v string", f"{root}/table")
    kept = {"processed_dir": f"{raw}/Processed", "backup_dir": f"{raw}/Backup"}
    _put(raw, ["one.csv", "two.csv", "three.csv"])
    real_write, real_move = files._write_batch, files._move

    def write(rows, path, batch_id, fmt="parquet"):
        if path.endswith(step):
            raise RuntimeError("lost")
        real_write(rows, path, batch_id, fmt)

    def move(s, raw_dir, processed, todo):
        if step == "after ledger":
            raise RuntimeError("lost")
        if step == "half moved":
            real_move(s, raw_dir, processed, todo[:1])
            raise RuntimeError("lost")
        real_move(s, raw_dir, processed, todo)

    monkeypatch.setattr(files, "_write_batch", write)
    monkeypatch.setattr(files, "_move", move)
    with pytest.raises(RuntimeError):
        files.ingest_new_files(*args, "b1", **kept)
    monkeypatch.setattr(files, "_write_batch", real_write)
    monkeypatch.setattr(files, "_move", real_move)
    finished = step in ("after ledger", "half moved")
    if step != "table":  # nothing is there to read yet
        assert files.loaded(spark, f"{root}/table", f"{root}/ledger").count() == (3 if finished else 0)
    _put(raw, ["four.csv"], 3)
    assert files.ingest_new_files(*args, "b2", **kept) == (1 if finished else 4)
    assert sorted(r.k for r in files.loaded(spark, f"{root}/table", f"{root}/ledger").collect()) == [0, 1, 2, 3]
    assert sorted(p.split("/")[-1] for p in _below(f"{raw}/Processed")) == ["four.csv", "one.csv", "three.csv", "two.csv"]
    assert [p for p in _below(raw) if not p.startswith(("Processed/", "Backup/"))] == []
    assert files.ingest_new_files(*args, "b3", **kept) == 0


def test_files_that_are_not_matched_are_an_error(spark, monkeypatch):
    root = files.scratch_dir(spark, "unmatched")
    _put(f"{root}/raw", ["a.csv", "b.csv"])
    uris = [r.file_path for r in files.list_files(spark, f"{root}/raw").collect()]
    monkeypatch.setattr(files, "_from_uri", lambda s, u: s._jvm.org.apache.hadoop.fs.Path(f"{root}/raw/a.csv"))
    with pytest.raises(files.LostFilesError, match="b.csv"):
        files.read_files(spark, uris, "k int, v string")


def test_unreadable_ledger_is_an_error_not_a_first_run(spark):
    from ledgerflow.sources import files
    root = files.scratch_dir(spark, "ledger")
    files.write_staging_csv(spark.range(3), f"{root}/raw")
    spark.createDataFrame([("x",)], "v string").write.text(f"{root}/ledger")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error for a file that is no table
        files.new_files(spark, f"{root}/raw", f"{root}/ledger").collect()


def test_velocity_counts_do_not_depend_on_the_batches(spark):
    from ledgerflow.sources import files
    from ledgerflow.streaming import jobs
    schema = "account_id long, transaction_timestamp timestamp"
    root = files.scratch_dir(spark, "velocity_test")
    days = ["2001-01-09", "2001-01-01", "2001-01-09", "2001-01-05", "2001-01-01", "2001-01-09"]
    for i, d in enumerate(days):  # one file each, out of order
        spark.sql(f"select 1L as account_id, timestamp '{d} 10:00:00' as transaction_timestamp").write.mode("append").parquet(f"{root}/in")
    out = jobs.velocity_alerts(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1)
    assert sorted((str(r.transaction_date), r.txn_count) for r in out.collect()) == [("2001-01-01", 2), ("2001-01-09", 3)]


def _arrive(spark, root, rows):
    schema = "transaction_id long, account_id long, transaction_timestamp timestamp_ntz"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return schema


def test_state_is_bounded_and_late_rows_are_listed(spark):
    """Ten days replayed one a batch with two days' lateness, late rows among them."""
    root = files.scratch_dir(spark, "lateness")
    start, made, expected, late = dt.datetime(2024, 3, 1, 9), 0, {}, []
    for d in range(10):
        rows = []
        for account in range(5):
            for _ in range(account % 2 + 1):
                rows.append((made, account, start + dt.timedelta(days=d)))
                made += 1
        for back in (1, 2, 3, 6):  # the third is late by the batch before: its day closed then
            if d >= back:
                rows.append((made, 9, start + dt.timedelta(days=d - back)))
                made += 1
        newest_before = d - 1
        for i, account, ts in rows:
            day = (ts - start).days
            if d and day < newest_before - 2:
                late.append(i)
            else:
                key = (account, ts.date())
                expected[key] = expected.get(key, 0) + 1
        schema = _arrive(spark, root, rows)
        streaming.velocity_alerts(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ck", lateness_days=2)
    marks = spark.read.option("basePath", f"{root}/out/marks").parquet(f"{root}/out/marks").orderBy("batch").collect()
    assert len(marks) == 10 and max(m.open_rows for m in marks) <= 3 * 6  # three open days of six keys
    assert len({m.open_rows for m in marks[4:]}) == 1  # no growth
    got = {(r.account_id, r.transaction_date): r.txn_count for r in streaming.velocity_counts(spark, f"{root}/out").collect()}
    assert got == expected
    listed = streaming.late_rows(spark, f"{root}/out", schema).collect()
    assert sorted(r.transaction_id for r in listed) == late and late
    assert sum(m.late_rows for m in marks) == len(late)


def test_a_replayed_batch_counts_once(spark):
    root = files.scratch_dir(spark, "replayed")
    schema = "transaction_id long, account_id long, transaction_timestamp timestamp_ntz"
    day = dt.datetime(2024, 1, 1)
    batches = [[(1, 1, day), (2, 1, None)], [(3, 1, day), (4, 2, day + dt.timedelta(days=9))], [(5, 1, day)]]
    for number, rows in enumerate(batches):
        for _ in range(3):  # a batch may fail after any of its writes and come again
            streaming.count_batch(spark.createDataFrame(rows, schema), number, f"{root}/t", "transaction_timestamp", "account_id", 3)
    got = sorted(((r.account_id, str(r.transaction_date), r.txn_count) for r in streaming.velocity_counts(spark, f"{root}/t").collect()))
    assert got == [(1, "2024-01-01", 2), (1, "None", 1), (2, "2024-01-10", 1)]
    assert [r.transaction_id for r in streaming.late_rows(spark, f"{root}/t", schema).collect()] == [5]


def test_merge_takes_the_newest_change_whatever_the_order(spark):
    root = files.scratch_dir(spark, "newest")
    schema = "k bigint, v string, changed timestamp_ntz"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    arrivals = [[(1, "new", t(5)), (1, "old", t(3)), (2, "a", t(1)), (2, "b", t(1)), (3, "x", None)],
                [(1, "late", t(4)), (2, "c", t(2)), (3, "y", t(0))]]
    for rows in arrivals:
        files.write_staging_csv(spark.createDataFrame(rows, schema), f"{root}/in/{len(rows)}")
        streaming.stream_merge(spark, f"{root}/in/*", schema, f"{root}/t", f"{root}/ck", ["k"], order_by="changed")
    assert sorted((r.k, r.v) for r in streaming.merged(spark, f"{root}/t", ["k"], "changed").collect()) == [(1, "new"), (2, "c"), (3, "y")]
