"""Source and sink round trips over the driver's tables (IO2, IO5-IO8, S1, S2).

Each job writes its staging files under the shared checkpoint folder (a
fresh directory per call), runs the source or sink, and returns what was
loaded, so the result can be compared with the rows that went in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import files
from ..sources.adapters import EVENTS_AS_OF, Tables
from ..streaming import jobs as streaming
from .meter import day_profiles, fold_half_hours
from .registry import job

EVENT_FILE_SCHEMA = "event_id bigint, user_id bigint, event_type string, value decimal(18,2), event_day date"
SPLIT_DAY = "2024-01-16"
VELOCITY_SPLIT = "1998-01-01 00:00:00"


def _event_rows(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type",
                           F.col("value").cast("decimal(18,2)").alias("value"),
                           F.col("ts").cast("date").alias("event_day"))


@job("csv_staging_scan")
def csv_staging_scan(t: Tables) -> DataFrame:
    """Meter reads staged as many CSV files, read back as one table."""
    path = files.scratch_dir(t.spark, "staging_csv")
    reads = t.meter_reads()
    files.write_staging_csv(reads, path)
    return files.read_staging_csv(t.spark, path, reads.schema)


@job("bulk_stage_load")
def bulk_stage_load(t: Tables) -> DataFrame:
    """Payments written to a time-stamped staging CSV, then appended to a table."""
    root = files.scratch_dir(t.spark, "bulk_load")
    return files.bulk_stage_load(t.stg_payments(), f"{root}/staging", f"{root}/table",
                                 run_id="parsedfile_20010801060000")


@job("meter_output")
def meter_output(t: Tables) -> DataFrame:
    """Half-hourly profiles written as CSV under load_date=yymmdd/qty=../,
    each (meter, qty) series whole in one file, read back with the
    partition values."""
    out = files.scratch_dir(t.spark, "meter_output")
    prof = day_profiles(fold_half_hours(t.meter_reads())).select(
        "meter_id", "qty", "read_day",
        F.array_join(F.col("hh_values").cast("array<string>"), ",").alias("hh_values"),
        F.array_join("hh_flags", ",").alias("hh_flags"))
    files.write_meter_output(prof, out, EVENTS_AS_OF.strftime("%y%m%d"))
    schema = "meter_id bigint, read_day date, hh_values string, hh_flags string, load_date string, qty string"
    return t.spark.read.schema(schema).option("basePath", out).csv(out)


@job("ingest_new_files")
def ingest_new_files(t: Tables) -> DataFrame:
    """Two arrivals of event files; each ingestion reads only the files of its own
    manifest, so every row lands once; read files move to Processed, a copy of the rows goes to Backup."""
    root = files.scratch_dir(t.spark, "ingest")
    raw, ledger, table = f"{root}/raw", f"{root}/ledger", f"{root}/table"
    ev = _event_rows(t)
    split = F.lit(SPLIT_DAY).cast("date")
    arrivals = (("arrival1", ev.where(F.col("event_day") < split)), ("arrival2", ev.where(F.col("event_day") >= split)), (None, None))
    for batch, (arrival, rows) in enumerate(arrivals, start=1):
        if arrival:
            files.write_staging_csv(rows, f"{raw}/{arrival}")
        files.ingest_new_files(t.spark, raw, ledger, EVENT_FILE_SCHEMA, table, f"b{batch}",
                               processed_dir=f"{raw}/Processed", backup_dir=f"{raw}/Backup")
    return files.loaded(t.spark, table, ledger)


@job("stream_ingest_files")
def stream_ingest_files(t: Tables) -> DataFrame:
    """S1: two drains of a landing folder with one checkpoint; files of the
    first arrival are archived and not read again."""
    root = files.scratch_dir(t.spark, "stream_ingest")
    land, table, ckpt, arch = f"{root}/landing", f"{root}/table", f"{root}/_checkpoint", f"{root}/archive"
    ev = _event_rows(t)
    split = F.lit(SPLIT_DAY).cast("date")
    files.write_staging_csv(ev.where(F.col("event_day") < split), f"{land}/arrival1")
    streaming.stream_merge(t.spark, f"{land}/*", EVENT_FILE_SCHEMA, table, ckpt, ["event_id"], archive_dir=arch)
    files.write_staging_csv(ev.where(F.col("event_day") >= split), f"{land}/arrival2")
    streaming.stream_merge(t.spark, f"{land}/*", EVENT_FILE_SCHEMA, table, ckpt, ["event_id"], archive_dir=arch)
    return streaming.merged(t.spark, table, ["event_id"])


@job("stream_velocity_alerts")
def stream_velocity_alerts(t: Tables) -> DataFrame:
    """S2: per-account daily counts at or above 2 from a transaction stream that comes in two
    arrivals by date, with a week's lateness; every day included."""
    root = files.scratch_dir(t.spark, "velocity")
    src, args = f"{root}/source", (f"{root}/counts", f"{root}/_checkpoint")
    tx = t.stg_transactions().select("transaction_id", "account_id", "transaction_timestamp")
    split = F.lit(VELOCITY_SPLIT).cast("timestamp_ntz")
    tx.where(F.col("transaction_timestamp") < split).write.mode("append").parquet(src)
    streaming.velocity_alerts(t.spark, src, tx.schema, *args, lateness_days=7)
    tx.where(~F.coalesce(F.col("transaction_timestamp") < split, F.lit(False))).write.mode("append").parquet(src)
    return streaming.velocity_alerts(t.spark, src, tx.schema, *args, lateness_days=7)
