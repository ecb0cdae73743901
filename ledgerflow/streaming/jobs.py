"""Structured Streaming jobs (S1, S2), built-in sources and sinks only.

S1 ``stream_ingest``: files arriving in a landing folder are read once each
(the stream checkpoint is the processed-file ledger) and written by the
Parquet file sink, whose commit log makes each batch exactly-once even when
a batch is replayed after a failure; processed files can be archived by the
source (``cleanSource=archive``).

``stream_merge`` does the same with an upsert by key and change time through ``foreachBatch``.

S2 ``velocity_alerts``: per-account daily transaction counts with a bound on lateness.
Open days are the only state; days behind the watermark are closed for good and rows that
come for them are listed, not lost. Spark's own ``withWatermark`` drops such
rows unseen, which is why the watermark is kept in a table beside the counts.
Within the bound the result equals the batch count of all rows, however they are
split over files and micro-batches.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import absent, discard


def stream_ingest(spark: SparkSession, landing_dir: str, schema: StructType | str, table_path: str,
                  checkpoint: str, archive_dir: str | None = None, fmt: str = "csv",
                  max_files_per_trigger: int | None = None) -> None:
    """Drain all files present now into the table, then stop (availableNow)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(landing_dir).writeStream.format("parquet").option("path", table_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def newest(rows: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row of each key: the last by ``order_by``; of rows equal in that, the greatest by all
    columns, so the result never depends on the order of arrival. Combined map-side."""
    values = [c for c in rows.columns if c not in keys]
    order = [*order_by, *[c for c in values if c not in order_by]]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("v"))
            .select(*keys, "v.*").select(*rows.columns))


def stream_merge(spark: SparkSession, landing_dir: str, schema: StructType | str, table_path: str, checkpoint: str,
                 keys: list[str], order_by: str | None = None, archive_dir: str | None = None, fmt: str = "csv",
                 max_files_per_trigger: int | None = None) -> None:
    """Drain all files present now; each micro-batch is written by ``foreachBatch`` as the
    partition of its number, so a replayed batch replaces itself. Of a batch's rows of one
    key the newest by ``order_by`` (the change time) stays. ``merged`` reads
    the table with newer rows taking the place of earlier ones of their key."""
    def write(batch: DataFrame, number: int) -> None:
        newest(batch, keys, [order_by] if order_by else []).write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(landing_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def merged(spark: SparkSession, table_path: str, keys: list[str], order_by: str | None = None) -> DataFrame:
    """The newest row of each key: by change time where ``order_by`` names it, else by batch."""
    rows = spark.read.parquet(table_path)
    return newest(rows, keys, [order_by, "batch"] if order_by else ["batch"]).drop("batch")


# ---- velocity: counts per key and day, with a bound on lateness -------------------
MARK_SCHEMA = "newest date, open_rows bigint, closed_rows bigint, late_rows bigint"
NO_BOUND = 1_000_000  # days: nothing is ever late


def _mark(spark: SparkSession, table_path: str, before: int):
    """(number, row) of the last batch that finished before batch ``before``, or None."""
    if absent(spark, f"{table_path}/marks"):
        return None
    marks = spark.read.schema(f"{MARK_SCHEMA}, batch int").option("basePath", f"{table_path}/marks").parquet(f"{table_path}/marks")
    return marks.where(F.col("batch") < before).orderBy(F.desc("batch")).first()


def count_batch(batch: DataFrame, number: int, table_path: str, ts_col: str, key: str, lateness_days: int) -> None:
    """Add one micro-batch to the counts per key and day under ``table_path``.

    A day is open until the newest day seen is more than ``lateness_days`` later: that is
    the watermark, taken from the batches before, so that it does not depend on the
    order of rows within a batch. Only open days are state: each batch writes
    them anew (``open``), appends the days it closes (``closed``) and lists rows of days closed
    before as they came (``late``). The batch's mark, written last, makes it
    count; a replayed batch reads the same earlier state and replaces itself.
    """
    spark = batch.sparkSession
    day = F.col(ts_col).cast("date")
    rows = batch.withColumn("transaction_date", day)
    last = _mark(spark, table_path, number)
    late_before = F.date_sub(F.lit(last["newest"]), lateness_days) if last is not None and last["newest"] is not None else None
    late = F.col("transaction_date") < late_before if late_before is not None else F.lit(False)
    late = F.coalesce(late, F.lit(False))

    rows.persist(StorageLevel.MEMORY_AND_DISK)  # counted and searched for late rows; lost blocks are read again
    day_counts = rows.where(~late).groupBy(key, "transaction_date").agg(F.count(F.lit(1)).alias("txn_count"))
    fresh, behind = f"{table_path}/fresh/batch={number}", f"{table_path}/late/batch={number}"
    day_counts.write.mode("overwrite").parquet(fresh)
    n_late = 0
    if late_before is not None:
        rows.where(late).drop("transaction_date").write.mode("overwrite").parquet(behind)
        n_late = spark.read.schema(batch.schema).parquet(behind).count()
    rows.unpersist()
    found = spark.read.schema(day_counts.schema).parquet(fresh).agg(F.max("transaction_date")).first()[0]
    newest_day = max((d for d in (found, last["newest"] if last else None) if d is not None), default=None)

    schema = day_counts.schema
    totals = spark.read.schema(schema).parquet(fresh)
    if last is not None:
        totals = totals.unionByName(spark.read.schema(schema).parquet(f"{table_path}/open/batch={last['batch']}"))
    totals = totals.groupBy(key, "transaction_date").agg(F.sum("txn_count").alias("txn_count"))
    closes = (F.coalesce(F.col("transaction_date") < F.date_sub(F.lit(newest_day), lateness_days), F.lit(False))
              if newest_day is not None else F.lit(False))
    counts = {}
    for name, which in (("open", ~closes), ("closed", closes)):
        path = f"{table_path}/{name}/batch={number}"
        totals.where(which).write.mode("overwrite").parquet(path)
        counts[name] = spark.read.schema(schema).parquet(path).count()  # from the files' footers
    mark = spark.createDataFrame([(newest_day, counts["open"], counts["closed"], n_late)], MARK_SCHEMA)
    mark.coalesce(1).write.mode("overwrite").parquet(f"{table_path}/marks/batch={number}")
    if last is not None and last["batch"] > 0:  # a replay starts from the state before its batch: one older is never read again
        for name in ("open", "fresh"):
            discard(spark, f"{table_path}/{name}/batch={last['batch'] - 1}")


def velocity_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """key, transaction_date, txn_count of all finished batches: closed days and the open ones of the last batch."""
    last = _mark(spark, table_path, 1 << 30)
    if last is None:
        raise ValueError(f"no finished batch under {table_path}")
    closed = spark.read.option("basePath", f"{table_path}/closed").parquet(f"{table_path}/closed").where(F.col("batch") <= last["batch"]).drop("batch")
    return closed.unionByName(spark.read.schema(closed.schema).parquet(f"{table_path}/open/batch={last['batch']}"))


def late_rows(spark: SparkSession, table_path: str, schema: StructType | str) -> DataFrame:
    """Rows beyond the bound, as they came, with the batch that brought them."""
    if absent(spark, f"{table_path}/late"):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    return spark.read.option("basePath", f"{table_path}/late").parquet(f"{table_path}/late")


def velocity_alerts(spark: SparkSession, source_dir: str, schema: StructType | str, table_path: str,
                    checkpoint: str, ts_col: str = "transaction_timestamp", key: str = "account_id",
                    limit: int = 2, max_files_per_trigger: int | None = None, lateness_days: int = NO_BOUND) -> DataFrame:
    """Days whose count reached ``limit``, whatever the files and micro-batches the rows came in,
    as long as none is later than ``lateness_days``; those are listed by ``late_rows``."""
    def write(batch: DataFrame, number: int) -> None:
        count_batch(batch, number, table_path, ts_col, key, lateness_days)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source_dir).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return velocity_counts(spark, table_path).where(F.col("txn_count") >= limit)
