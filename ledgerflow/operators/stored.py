"""Tables on storage: merge by key, histories, and column changes.

* ``merge_stored``   - upsert (and delete) by key into a table dealt into hash buckets of its
  key (IN2/IN3): only the buckets that the updates touch are read and rewritten
* ``snapshot_store`` - one snapshot run into a stored history (H1/H2): a run writes the open
  versions and the ones it closes, by closing month; closed history is never read or written again
* ``register_columns``, ``read_synced`` - a registry of a table's columns beside it (IN11): new
  and dropped columns follow the latest write, other changes are refused by name

Parquet folders have no transactions. Each operator writes aside first, in full, and
says so by a marker; a run that finds a finished one applies it before it goes on, an
unfinished one is thrown away. Repeating a run thus repeats no row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.files import absent, discard
from .incremental import assert_unique_keys
from .scd2 import VALID_TO, snapshot_apply

BUCKET = "key_bucket"
BUCKETS = 64


# ---- merge ---------------------------------------------------------------------------
def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}__staged"


def _dealt(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows with their bucket, dealt so that each bucket has few files of a good size: AQE
    splits a large bucket and puts small ones together."""
    return rows.withColumn(BUCKET, key_bucket(keys, buckets)).hint("rebalance", BUCKET)


def _apply(spark: SparkSession, path: str) -> None:
    """Put finished staged buckets in the place of the table's, then forget them."""
    staged = _staged(path)
    touched = [r[0] for r in spark.read.parquet(f"{staged}/touched").collect()]  # at most the number of buckets
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(f"{staged}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    filled = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    for b in touched:
        if b not in filled:  # all of its keys were deleted
            discard(spark, f"{path}/{BUCKET}={b}")
    discard(spark, staged)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or forget a merge that did not end."""
    staged = _staged(path)
    if not absent(spark, f"{staged}/touched/_SUCCESS"):
        _apply(spark, path)
    elif not absent(spark, staged):
        discard(spark, staged)


def _buckets_of(spark: SparkSession, path: str) -> int | None:
    if absent(spark, f"{path}/_buckets"):
        return None
    return int(spark.read.text(f"{path}/_buckets").first()[0])


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


class Merged(NamedTuple):
    rows: int  # updates
    buckets: int  # rewritten


def merge_stored(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], buckets: int = BUCKETS,
                 deletes: DataFrame | None = None) -> Merged:
    """Rows of ``updates`` take the place of stored rows with the same key, others are added;
    keys in ``deletes`` leave.

    A table that is not there is written whole, with the given number of buckets; later merges
    keep that number. Keys are compared null-safe and must not repeat in ``updates``, which may
    read the table itself. Files of untouched buckets stay as they are.
    """
    recover(spark, path)
    keys = list(keys)
    if _buckets_of(spark, path) is None:
        assert_unique_keys(updates, keys)
        _dealt(updates, keys, buckets).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)
        spark.createDataFrame([(str(buckets),)], "n string").coalesce(1).write.mode("overwrite").text(f"{path}/_buckets")
        return Merged(spark.read.parquet(path).count(), buckets)
    buckets = _buckets_of(spark, path)
    staged = _staged(path)
    _dealt(updates, keys, buckets).write.mode("overwrite").parquet(f"{staged}/updates")  # read several times below
    new = spark.read.parquet(f"{staged}/updates")
    n = new.count()
    assert_unique_keys(new, keys)
    gone = new.select(*keys)
    if deletes is not None:
        gone = gone.unionByName(deletes.select(*keys)).distinct()
    touched = gone.select(key_bucket(keys, buckets).alias(BUCKET)).distinct()
    numbers = [r[0] for r in touched.collect()]  # at most ``buckets``
    if numbers:
        old = spark.read.parquet(path).where(F.col(BUCKET).isin(numbers))  # a partition filter: no other bucket is listed
        same = None
        replaced = gone.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        for k in keys:
            e = old[k].eqNullSafe(replaced[f"_k_{k}"])
            same = e if same is None else same & e
        rows = old.join(replaced, same, "left_anti").unionByName(new)
        rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{staged}/rows")
        touched.coalesce(1).write.mode("overwrite").parquet(f"{staged}/touched")  # from here on the merge counts
        _apply(spark, path)
    discard(spark, staged)
    return Merged(n, len(numbers))


# ---- history --------------------------------------------------------------------------
STATE, MONTH, RUN = "version_state", "closed_month", "snapshot_run"


class RunOrderError(ValueError):
    pass


def _run_id(run_ts: str) -> str:
    return "".join(c for c in run_ts if c.isdigit())


def _runs(spark: SparkSession, path: str) -> list[str]:
    """Finished runs, ascending: one marker each."""
    if absent(spark, f"{path}/_runs"):
        return []
    return sorted(r[0] for r in spark.read.text(f"{path}/_runs").distinct().collect())


def _part(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions: those closed by any run and the open ones of the last."""
    runs = _runs(spark, path)
    if not runs:
        raise ValueError(f"no finished run under {path}")
    rows = spark.read.parquet(path).withColumn(RUN, F.col(RUN).cast("string"))
    kept = F.col(RUN).isin(runs) & ((F.col(STATE) == "closed") | (F.col(RUN) == runs[-1]))
    return rows.where(kept).drop(STATE, MONTH, RUN)


def snapshot_store(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], updated_at: str, run_ts: str,
                   hard_delete: bool = False) -> DataFrame:
    """Apply one run of ``source`` (one row per key) at ``run_ts``; the history after it.

    Reads the open versions of the run before and writes ``snapshot_run=<time>/version_state=open`` and
    ``version_state=closed/closed_month=..``: what is open now and what this run closed. Rows closed
    earlier are not touched. The last run may be repeated and replaces itself; an earlier
    one is refused. Open versions two runs old are removed.
    """
    run, runs = _run_id(run_ts), _runs(spark, path)
    if runs and run < runs[-1]:
        raise RunOrderError(f"run {run} is before the last one, {runs[-1]}")
    before = [r for r in runs if r < run]
    opened = None
    if before:
        opened = spark.read.parquet(f"{path}/{RUN}={before[-1]}").where(F.col(STATE) == "open").drop(STATE, MONTH)
    after = snapshot_apply(opened, source, keys, updated_at, F.lit(run_ts).cast("timestamp_ntz"), hard_delete)
    is_open = F.col(VALID_TO).isNull()
    (after.withColumn(STATE, F.when(is_open, "open").otherwise("closed"))
     .withColumn(MONTH, F.when(is_open, "none").otherwise(F.date_format(VALID_TO, "yyyy-MM")))
     .hint("rebalance", STATE, MONTH)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(STATE, MONTH).parquet(f"{path}/{RUN}={run}"))
    if run not in runs:
        spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("append").text(f"{path}/_runs")
    for old in before[:-1]:
        discard(spark, f"{path}/{RUN}={old}/{STATE}=open")
    return read_history(spark, path)


# ---- columns --------------------------------------------------------------------------
class SchemaChangeError(ValueError):
    pass


def _registry(path: str) -> str:
    return f"{path.rstrip('/')}__columns"


def registered(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    """(version, columns) of the table at ``path``; a column is its name, its name in the
    files, and its type; dropped ones are kept to know their names in the files."""
    if absent(spark, _registry(path)):
        return 0, []
    last = spark.read.parquet(_registry(path)).orderBy(F.desc("version")).first()
    return last["version"], json.loads(last["columns"])


def register_columns(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the column names of the table's files, once the registry knows their columns.

    A column that the table has not had is added (older rows: null), one that ``rows`` has not is
    dropped; one that comes back after it was dropped is another column, so
    values from before do not return. A column whose type or spelling (upper or lower case) differs raises.
    """
    version, columns = registered(spark, path)
    current = {c["name"]: c for c in columns if c["live"]}
    fields = {f.name: f.dataType for f in rows.schema.fields}
    by_lower = {n.lower(): n for n in current}
    wrong = [f"{n}: {by_lower[n.lower()]} is stored" for n in fields if n.lower() in by_lower and by_lower[n.lower()] != n]
    wrong += [f"{n}: {current[n]['type']} is stored, {t.simpleString()} came" for n, t in fields.items()
              if n in current and json.loads(current[n]["json"]) != json.loads(t.json())]
    if wrong:
        raise SchemaChangeError(f"{path}: {'; '.join(sorted(wrong))}")
    taken = {c["physical"].lower() for c in columns}
    changed = [c | {"live": c["live"] and c["name"] in fields} for c in columns]
    for n, t in fields.items():
        if n not in current:
            physical = n if n.lower() not in taken else f"{n}__{version + 1}"
            changed.append({"name": n, "physical": physical, "type": t.simpleString(), "json": t.json(), "live": True})
    if changed != columns:
        spark.createDataFrame([(version + 1, json.dumps(changed))], "version int, columns string").coalesce(1).write.mode("append").parquet(_registry(path))
    physical = {c["name"]: c["physical"] for c in changed if c["live"]}
    return rows.select(*[F.col(f"`{n}`").alias(physical[n]) for n in fields])


def forget_columns(spark: SparkSession, path: str) -> None:
    """Before a table is rebuilt whole."""
    discard(spark, _registry(path))


def read_synced(spark: SparkSession, path: str, also: Sequence[str] = ()) -> DataFrame:
    """The table with its present columns, in the order they came to it, and the partition columns ``also``."""
    _, columns = registered(spark, path)
    if not columns:
        return spark.read.parquet(path)
    live = [c for c in columns if c["live"]]
    schema = StructType([StructField.fromJson({"name": c["physical"], "type": json.loads(c["json"]), "nullable": True, "metadata": {}}) for c in live])
    for name in also:
        schema = schema.add(name, "string")
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{c['physical']}`").alias(c["name"]) for c in live], *also)
