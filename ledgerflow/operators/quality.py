"""Data-quality checks (Q1-Q15).

Every check is a function returning the *failing* rows as a DataFrame (empty
means pass). ``check_summary`` folds any number of checks into one small
DataFrame of (check_name, failures) evaluated in a single job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str], model_name: str = "model") -> None:
    """Fail before running when required columns are absent (case-insensitive)."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in have]
    if missing:
        raise MissingColumnsError(
            f"{model_name}: {len(missing)} expected column(s) absent, namely {', '.join(missing)}")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str] | str, count_col: str = "n_records") -> DataFrame:
    """Key values occurring more than once (grouped; combines map-side)."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join)."""
    parents = to.select(F.col(field).alias("_parent_key"))  # an anti join needs no distinct keys
    child = df.where(F.col(column).isNotNull())
    return child.join(parents, child[column] == parents["_parent_key"], "left_anti")


def orphan_count(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Number of the rows that ``relationships`` returns, as ``failures``. Rows are counted by
    key before the anti join, so a key that most rows share is a few rows of it, not one task's work."""
    by_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    return relationships(by_key, column, to, field).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures"))


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str,
                        from_condition: str = "1=1", to_condition: str = "1=1") -> DataFrame:
    return relationships(df.where(from_condition), column, to.where(to_condition), field)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    e = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~e)


def no_overlapping_ranges(df: DataFrame, partition_by: Sequence[str] | str,
                          lower: str | Column, upper: str | Column) -> DataFrame:
    """Rows whose range overlaps the next range of the same key (half-open)."""
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    lo = F.expr(lower) if isinstance(lower, str) else lower
    hi = F.expr(upper) if isinstance(upper, str) else upper
    d = df.withColumn("_lo", lo).withColumn("_hi", hi)
    w = Window.partitionBy(*keys).orderBy("_lo", "_hi")
    return (d.withColumn("_next_lo", F.lead("_lo").over(w))
            .where(F.col("_next_lo") < F.col("_hi"))
            .drop("_lo", "_hi", "_next_lo"))


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Audit report of duplicate key values with their count (Q13)."""
    return unique(df, columns, "record_count")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: (column_name, null_count, row_count), one scan (Q14)."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, null_count)", "_rows") \
        .withColumnRenamed("_rows", "row_count")


def row_count_reconciliation(source: DataFrame, target: DataFrame, source_name: str,
                             target_name: str) -> DataFrame:
    """source vs target row counts and their difference in one row (Q12)."""
    target_count = target.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    return (source.agg(F.count(F.lit(1)).alias("source_count"))
            .select(F.lit(source_name).alias("source_table"), F.lit(target_name).alias("target_table"),
                    "source_count", target_count.alias("target_count"))
            .withColumn("count_difference", F.col("source_count") - F.col("target_count")))


def check_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, failures, status) for every check, evaluated in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def load_freshness(spark: SparkSession, sources: Sequence[tuple[str, str, int, int]], as_of: str) -> DataFrame:
    """source, loaded_at, age_hours, status of each (source, path, warn hours, error hours).

    A source's load time is the newest change of its files, from their listing: no data is
    read. Without files the status is ``missing``.
    """
    out = None
    for name, path, warn, error in sources:
        try:
            files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                     .where(~F.col("_metadata.file_name").rlike("^[_.]")).select(F.col("modificationTime").alias("at")))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            files = spark.createDataFrame([], "at timestamp")
        row = files.agg(F.max("at").alias("loaded_at")).select(
            F.lit(name).alias("source"), "loaded_at",
            F.round((F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("loaded_at")) / 3600, 2).alias("age_hours"),
            F.lit(warn).alias("warn_hours"), F.lit(error).alias("error_hours"))
        out = row if out is None else out.unionByName(row)
    age = F.col("age_hours")
    return out.withColumn("status", F.when(age.isNull(), "missing").when(age > F.col("error_hours"), "error")
                          .when(age > F.col("warn_hours"), "warn").otherwise("pass"))
