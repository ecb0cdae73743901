"""Incremental load operators (IN1-IN11) over plain Parquet tables.

DataFrame-level forms (lazy; used by jobs and tests):

* ``high_water_mark``       - max of a target column, null-safe (one-row aggregate)
* ``hwm_filter``            - source rows past the mark (literal filter: pushes to the scan)
* ``incremental_filter``    - inclusive mark; pair with ``append_new`` to stay idempotent
* ``append_new``            - append rows whose key is not in the target (IN1)
* ``merge``                 - upsert by key: target minus updated keys, plus updates (IN2/IN3)
* ``merge_once``            - the same for one row a key, reading the updates once
* ``insert_overwrite``      - replace whole partitions present in the new rows (IN4)
* ``schema_sync``           - align old rows to the new column set (IN11)
* ``lookback_filter``       - rows on or after as_of minus N days / months (IN8)

Storage-level form: ``write_partitions``, Spark's dynamic partition overwrite.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MARK = "1900-01-01"


class DuplicateKeyError(ValueError):
    pass


def high_water_mark(target: DataFrame | None, col: str, default: str = DEFAULT_MARK):
    """max(target.col), or ``default`` for an empty/missing target. One row
    reaches the driver; the value becomes a literal in the next filter."""
    if target is None:
        return default
    v = target.agg(F.max(col).alias("m")).first()["m"]
    return default if v is None else v


def _lit_like(value, dtype: str | None = None) -> Column:
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    c = F.lit(value)
    return c.cast(dtype) if dtype else c


def past_mark(source_col: Column, target: DataFrame | None, target_col: str, inclusive: bool = False,
              default: str = DEFAULT_MARK, as_type: str = "timestamp_ntz") -> Column:
    """The condition ``source_col > coalesce(max(target_col), default)`` (``>=`` when
    inclusive) with the mark as a literal, so that it reaches the source's scan."""
    m = _lit_like(high_water_mark(target, target_col, default), as_type)
    return source_col >= m if inclusive else source_col > m


def hwm_filter(source: DataFrame, source_col: str, target: DataFrame | None, target_col: str,
               inclusive: bool = False, default: str = DEFAULT_MARK, as_type: str | None = None) -> DataFrame:
    """Rows of ``source`` past the target's mark."""
    c = F.col(source_col).cast(as_type) if as_type else F.col(source_col)
    return source.where(past_mark(c, target, target_col, inclusive, default,
                                  as_type or source.schema[source_col].dataType.simpleString()))


def incremental_filter(source: DataFrame, col: str, target: DataFrame | None, target_col: str | None = None,
                       as_type: str | None = None) -> DataFrame:
    """Inclusive bound ``col >= max_loaded(target)``; rows already loaded on the
    boundary are removed by ``append_new``'s anti-join."""
    return hwm_filter(source, col, target, target_col or col, inclusive=True, as_type=as_type)


def append_new(target: DataFrame | None, new: DataFrame, keys: Sequence[str], boundary: str | None = None) -> DataFrame:
    """``target`` plus the rows of ``new`` whose key it does not hold. With ``boundary``,
    the column that the inclusive mark was taken from, only the target's rows on the
    mark can repeat a key: the anti-join reads those alone."""
    if target is None:
        return new
    known = target
    if boundary:
        mark = high_water_mark(target, boundary, None)
        if mark is None:
            return target.unionByName(new)
        known = target.where(F.col(boundary) >= _lit_like(mark, target.schema[boundary].dataType.simpleString()))
    fresh = new.join(known.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh)


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail on duplicate keys in an update set (reads at most one row back)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate merge key {dict(zip(keys, dup[0][:len(keys)]))}")


def merge(target: DataFrame | None, updates: DataFrame, keys: Sequence[str],
          check_unique: bool = False) -> DataFrame:
    """Upsert: rows of ``updates`` replace target rows with the same key."""
    if check_unique:
        assert_unique_keys(updates, keys)
    if target is None:
        return updates
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates)


def merge_once(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``merge`` of one row for each key on both sides, the updates computed once: an outer
    join takes the updated row where there is one. Null keys match nothing, as in ``merge``."""
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*[F.col(c).alias(f"_o_{c}") for c in keys], F.struct(*rest).alias("_old"))
    new = updates.select(*keys, F.struct(*rest).alias("_new"))
    cond = None
    for c in keys:
        e = F.col(f"_o_{c}") == F.col(c)
        cond = e if cond is None else cond & e
    j = old.join(new, cond, "full_outer")
    row = F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return j.select(*[F.when(F.col("_new").isNotNull(), F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in keys],
                    row.alias("_row")).select(*keys, "_row.*").select(*target.columns)


def insert_overwrite(target: DataFrame | None, new: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Partitions present in ``new`` are replaced whole; others are kept."""
    if target is None:
        return new
    touched = new.select(*[F.col(c).alias(f"_p_{c}") for c in partition_cols]).distinct()
    cond = None
    for c in partition_cols:  # null-safe: a null partition value is a partition too
        e = target[c].eqNullSafe(touched[f"_p_{c}"])
        cond = e if cond is None else cond & e
    return target.join(touched, cond, "left_anti").unionByName(new)


def schema_sync(target: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows gain the new columns (null) and lose dropped ones."""
    return target.unionByName(new, allowMissingColumns=True).select(*new.columns)


def lookback_filter(df: DataFrame, col: str, as_of: dt.date, days: int = 0, months: int = 0) -> DataFrame:
    start = F.lit(str(as_of)).cast("date")
    if months:
        start = F.trunc(F.add_months(start, -months), "month")
    if days:
        start = F.date_sub(start, days)
    return df.where(F.col(col) >= start)


# ---------------------------------------------------------------- storage
def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced.
    ``df`` must not read ``path`` itself: store such an increment first."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)
