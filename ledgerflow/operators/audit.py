"""Audit columns and run-log rows (Q16, Q17).

Run metadata is passed in as a ``RunContext`` (never read from the clock
inside a transformation), so a job's output is reproducible. Row counts for
the log come from the data itself: a lazy count aggregate for reports, or
``DataFrame.observe`` on a write so the count costs no second scan.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class RunContext:
    business_date: dt.date
    run_started_at: dt.datetime
    invocation_id: str
    target_name: str = "dev"


def with_audit_columns(df: DataFrame, run: RunContext, include_updated_at: bool = True) -> DataFrame:
    """business_date, created_at, [updated_at], run id, run start, target env."""
    started = F.lit(run.run_started_at.isoformat(sep=" ")).cast("timestamp_ntz")
    cols = {
        "business_date": F.lit(str(run.business_date)).cast("date"),
        "created_at": started,
    }
    if include_updated_at:
        cols["updated_at"] = started
    cols.update({
        "dbt_invocation_id": F.lit(run.invocation_id),
        "dbt_run_started_at": started,
        "dbt_target_env": F.lit(run.target_name),
    })
    return df.withColumns(cols)


def audit_log_row(df: DataFrame, model_name: str, run: RunContext, database: str = "analytics",
                  schema: str = "public", count_rows: bool = True) -> DataFrame:
    """One log row for ``model_name``; row_count is a lazy count of ``df`` (or null)."""
    n = df.agg(F.count(F.lit(1)).alias("row_count")) if count_rows else \
        df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
    return n.select(
        F.lit(model_name).alias("model_name"), F.lit(database).alias("database_name"),
        F.lit(schema).alias("schema_name"), F.lit(str(run.business_date)).cast("date").alias("business_date"),
        F.lit(run.run_started_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_started_at"),
        F.lit(run.invocation_id).alias("invocation_id"), F.lit(run.target_name).alias("target_name"),
        "row_count")


class Written(NamedTuple):
    rows: int
    partitions: set  # values of the first partition column that rows were written for


def write_with_audit(df: DataFrame, path: str, model_name: str, run: RunContext, log_path: str,
                     mode: str = "overwrite", partition_by: list[str] | None = None, only_touched: bool = False) -> int:
    """Write ``df`` and append its audit row; returns the number of rows."""
    return write_observed(df, path, model_name, run, log_path, mode, partition_by, only_touched).rows


def write_observed(df: DataFrame, path: str, model_name: str, run: RunContext, log_path: str,
                   mode: str = "overwrite", partition_by: list[str] | None = None, only_touched: bool = False) -> Written:
    """Write ``df`` and append its audit row; count and partitions are observed during the
    write itself (no second pass over the data). With ``only_touched`` the
    partitions that ``df`` has no row of stay as they are."""
    obs = Observation(f"audit_{model_name}")
    seen = F.collect_set(partition_by[0]) if partition_by else F.collect_set(F.lit(None).cast("string"))
    w = df.observe(obs, F.count(F.lit(1)).alias("n"), seen.alias("seen")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("partitionOverwriteMode", "dynamic" if only_touched else "static").parquet(path)
    found = obs.get
    append_log(df.sparkSession, model_name, run, log_path, int(found["n"]))
    return Written(int(found["n"]), set(found["seen"]))


def append_log(spark: SparkSession, model_name: str, run: RunContext, log_path: str, n: int) -> None:
    row = spark.createDataFrame(
        [(model_name, "analytics", "public", run.business_date, run.run_started_at, run.invocation_id,
          run.target_name, n)],
        "model_name string, database_name string, schema_name string, business_date date, "
        "run_started_at timestamp_ntz, invocation_id string, target_name string, row_count bigint")
    row.write.mode("append").parquet(log_path)
