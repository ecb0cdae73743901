"""Distinct counts that can be merged: a sketch for each group and period, stored beside the
exact counts (A3).

An exact distinct count of a year needs the year's rows; the sketches of its months
are merged instead. A sketch is a set: adding rows again changes nothing, so an
increment may re-read what it has read before. The error is about
1.04 / sqrt(2^lg_k): 0.8 % with the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import absent

LG_K = 14
SKETCH, RUN = "sketch", "sketch_run"


def distinct_sketches(rows: DataFrame, keys: Sequence[str], column: str, lg_k: int = LG_K) -> DataFrame:
    """keys, sketch of the distinct non-null values of ``column``; combined map-side, so a hot group is a
    few sketches when it meets."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), F.lit(lg_k)).alias(SKETCH))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, sketch: those of finer groups, periods or runs put together."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimates(sketches: DataFrame, name: str) -> DataFrame:
    return sketches.withColumn(name, F.hll_sketch_estimate(SKETCH)).drop(SKETCH)


def store_sketches(sketches: DataFrame, path: str, run_id: str) -> None:
    """Write one run's sketches as its own partition; a repeated run replaces itself."""
    sketches.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN}={run_id}")


def stored_estimates(spark: SparkSession, path: str, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct counts by ``keys``, any part of the stored ones, over all runs."""
    if absent(spark, path):
        raise ValueError(f"no sketches under {path}")
    return estimates(merge_sketches(spark.read.parquet(path), keys), name)
