"""File sources and sinks (IO2, IO5-IO8) and scratch locations.

Scratch data (staging files, ledgers, replay tables) lives under the shared
folder named by ``spark.checkpoint.dir`` - never a machine-local temp dir -
so any executor can read what another wrote and a lost executor's work can
be recomputed or re-read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for one run under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerflow/{name}/{uuid.uuid4().hex[:12]}"


# ---- CSV staging -------------------------------------------------------------
def write_staging_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def read_staging_csv(spark: SparkSession, prefix: str, schema: StructType | str) -> DataFrame:
    """All CSV files under ``prefix`` as one table, one distributed scan
    (explicit schema: no inference pass over the data)."""
    return (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
            .csv(prefix))


def bulk_stage_load(df: DataFrame, staging_root: str, table_path: str, run_id: str) -> DataFrame:
    """Write rows as CSV to ``staging_root/run_id``, then append them to the
    Parquet table (the COPY step); returns the table."""
    stage = f"{staging_root.rstrip('/')}/{run_id}"
    write_staging_csv(df, stage)
    staged = read_staging_csv(df.sparkSession, stage, df.schema)
    staged.write.mode("append").parquet(table_path)
    return df.sparkSession.read.parquet(table_path)


# ---- partitioned meter output ---------------------------------------------------
def write_meter_output(profiles: DataFrame, out_root: str, load_date: str) -> str:
    """Profiles as CSV under ``load_date=yymmdd/qty=../``; every (meter, qty)
    series lies whole in one file, its rows sorted by day.

    Hash-partitioning on (meter, qty) sends each series to one task, and the
    sort puts its days together in order; the number of files follows the
    partition count, not the number of meters (one file per meter would be
    hundreds of millions of small files at scale).
    """
    (profiles.withColumn("load_date", F.lit(load_date))
     .repartition("meter_id", "qty").sortWithinPartitions("qty", "meter_id", "read_day")
     .write.mode("overwrite").option("header", False)
     .partitionBy("load_date", "qty").csv(out_root))
    return out_root


# ---- new-file ingestion with a processed-file ledger ----------------------------
LEDGER_SCHEMA = "file_path string, file_size bigint, modified timestamp, batch_id string"
FILE = ["file_path", "file_size", "modified"]  # one delivery: a later file of the same name is another
# Sub-folders of the raw area that are never ingested, plus
# Spark's own marker files (_SUCCESS, _committed...).
SKIP_FOLDERS = ("/Processed/", "/Backup/", "/staging/", "/_")
MAX_FILES = 10_000  # files of one batch: all that the driver ever holds of a listing
GLOB = str.maketrans({c: "\\" + c for c in "\\{}[]*?^"})


class LostFilesError(RuntimeError):
    """A batch did not read exactly the files of its manifest."""


def list_files(spark: SparkSession, raw_dir: str, skip_prefixes: Sequence[str] = ()) -> DataFrame:
    """(file_path, file_size, modified) of every non-empty file under ``raw_dir``.

    Paths are URIs, as every scan names its files (``_metadata.file_path``); the
    listing is a ``binaryFile`` scan with the content column pruned.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_dir)
             .select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"),
                     F.col("modificationTime").alias("modified"))
             .where(F.col("file_size") > 0))
    hadoop, fs = _path(spark, raw_dir)
    base = fs.makeQualified(hadoop).toUri().getRawPath().rstrip("/")
    # the part of the path below raw_dir
    rel = F.substr(F.regexp_replace("file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit(len(base) + 1))
    for p in skip_prefixes:
        files = files.where(~rel.contains(p))
    return files


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system) of a path string; of a URI, decoded."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _from_uri(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def absent(spark: SparkSession, path: str) -> bool:
    """Whether nothing is stored at ``path``; any other trouble is an error of its own."""
    hadoop, fs = _path(spark, path)
    return not fs.exists(hadoop)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that no reader needs any more, if it is there."""
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column, as its folders name them."""
    hadoop, fs = _path(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(hadoop) if f.isDirectory()]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__"))


def _ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", ledger_path).parquet(ledger_path)


def new_files(spark: SparkSession, raw_dir: str, ledger_path: str,
              skip_prefixes: Sequence[str] = ()) -> DataFrame:
    """Files that are in no finished batch of the ledger."""
    files = list_files(spark, raw_dir, skip_prefixes)
    if absent(spark, ledger_path):
        return files
    return files.join(_ledger(spark, ledger_path).select(*FILE), FILE, "left_anti")


def read_files(spark: SparkSession, uris: Sequence[str], schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """The rows of exactly these files: the scan lists and opens no other. Names are taken
    literally, whatever blanks, signs or pattern characters they hold."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    rows = reader.format(fmt).load([_from_uri(spark, u).toString().translate(GLOB) for u in uris])
    plain = lambda names: {u.replace(":///", ":/", 1) for u in names}  # noqa: E731  an empty authority is written or not
    matched, listed = plain(rows.inputFiles()), plain(uris)
    if matched != listed:
        raise LostFilesError(f"{len(listed)} files listed, {len(matched)} matched; they differ in {sorted(matched ^ listed)[:5]}")
    return rows


def ingest_new_files(spark: SparkSession, raw_dir: str, ledger_path: str, schema: StructType | str,
                     table_path: str, batch_id: str, fmt: str = "csv", processed_dir: str | None = None,
                     backup_dir: str | None = None, max_files: int = MAX_FILES) -> int:
    """Load files that no finished batch has read, as partition ``batch_id`` of the table.

    1. Files of finished batches that still lie in the landing area are moved to
       ``processed_dir`` (what a crash after step 4 left).
    2. The batch takes at most ``max_files`` of the others, oldest first, and reads
       exactly these; its partition of the table is overwritten, so a repeated
       batch replaces itself.
    3. A copy of the batch's rows goes from the table to ``backup_dir``.
    4. The files enter the ledger, as the batch's own partition: the batch is finished.
    5. The files move to ``processed_dir/batch_id=..``, keeping their names below ``raw_dir``.

    A crash before step 4 leaves the batch unfinished: the next run with the same or
    another id reads its files again, and readers of ``loaded`` see finished
    batches only, so nothing lands twice; a crash after it costs the moves alone, which step 1
    of the next run makes up for. Later batches never list or read a moved file. Without
    ``processed_dir`` files stay where they are. Returns the number of files; call again until it is 0.
    """
    if processed_dir:
        retire(spark, raw_dir, ledger_path, processed_dir, max_files)
    todo = (new_files(spark, raw_dir, ledger_path, skip_prefixes=SKIP_FOLDERS)
            .orderBy("modified", "file_path").limit(max_files).collect())  # at most max_files names
    if not todo:
        return 0
    _write_batch(read_files(spark, [r["file_path"] for r in todo], schema, fmt), table_path, batch_id)
    if backup_dir:
        _write_batch(spark.read.schema(schema).parquet(_batch(table_path, batch_id)), backup_dir, batch_id, fmt)
    _write_batch(spark.createDataFrame(todo, "file_path string, file_size bigint, modified timestamp"), ledger_path, batch_id)
    if processed_dir:
        _move(spark, raw_dir, processed_dir, [(r["file_path"], batch_id) for r in todo])
    return len(todo)


def retire(spark: SparkSession, raw_dir: str, ledger_path: str, processed_dir: str, max_files: int = MAX_FILES) -> int:
    """Move files of finished batches that still lie in the landing area, ``max_files`` at a time; their number."""
    if absent(spark, ledger_path) or absent(spark, raw_dir):
        return 0
    moved = 0
    while True:
        left = (list_files(spark, raw_dir, SKIP_FOLDERS).join(_ledger(spark, ledger_path), FILE)
                .select("file_path", "batch_id").limit(max_files).collect())
        if not left:
            return moved
        _move(spark, raw_dir, processed_dir, [tuple(r) for r in left])
        moved += len(left)


def _move(spark: SparkSession, raw_dir: str, processed_dir: str, files: Sequence[tuple[str, str]]) -> None:
    """Rename each (file, batch): no content passes the driver."""
    hadoop, fs = _path(spark, raw_dir)
    base = fs.makeQualified(hadoop).toUri().getPath().rstrip("/")
    for uri, batch_id in files:
        source = _from_uri(spark, uri)
        below = source.toUri().getPath().removeprefix(base).lstrip("/")
        target, fs = _path(spark, f"{processed_dir.rstrip('/')}/batch_id={batch_id}/{below}")
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"cannot move {uri} to {target.toString()}")


def _batch(path: str, batch_id: str) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def _write_batch(rows: DataFrame, path: str, batch_id: str, fmt: str = "parquet") -> None:
    """Replace the batch's partition of the table at ``path``, and no other."""
    w = rows.write.mode("overwrite").format(fmt)
    (w.option("header", True) if fmt == "csv" else w).save(_batch(path, batch_id))


def loaded(spark: SparkSession, table_path: str, ledger_path: str) -> DataFrame:
    """The rows of the table's finished batches."""
    if absent(spark, ledger_path):
        return spark.read.parquet(table_path).limit(0).drop("batch_id")
    finished = _ledger(spark, ledger_path).select("batch_id").distinct()
    rows = spark.read.parquet(table_path).withColumn("batch_id", F.col("batch_id").cast("string"))
    return rows.join(finished, "batch_id", "left_semi").drop("batch_id")
