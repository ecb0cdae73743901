"""Type-2 history operators.

* ``close_versions``  - version chain from a change log (H7): each version ends
  where the next one for the same key starts (half-open intervals);
  ``close_versions_chunked`` is the form for hot keys.
* ``snapshot_apply``  - timestamp-strategy snapshot (H1) with optional
  hard-delete invalidation (H2): one full-outer join of the open versions with
  the current source state on the business key.
* ``compress_runs``   - collapse consecutive equal values of an ordered series
  into periods (G2); ``compress_runs_chunked`` is the form for hot keys.
* ``latest_per_key``  - current state of a change log (one row per key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
UPDATED_AT = "dbt_updated_at"
SCD_ID = "dbt_scd_id"


def close_versions(df: DataFrame, keys: Sequence[str], valid_from: str,
                   valid_to: str = VALID_TO, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``valid_to`` = the next ``valid_from`` of the same key (null = current).

    The input should hold one row per (key, valid_from): reduce a raw change
    log with ``latest_per_key(log, [*keys, valid_from], tiebreak)`` first, so
    the window holds at most one row per key and distinct change time; use
    ``close_versions_chunked`` when one key may hold a large share of them.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(valid_from), *[F.col(c) for c in tiebreak])
    return df.withColumn(valid_to, F.lead(valid_from).over(w))


def close_versions_chunked(df: DataFrame, keys: Sequence[str], valid_from: str,
                           valid_to: str = VALID_TO, unit: str = "month") -> DataFrame:
    """``close_versions`` that never puts one key's whole history in one task.

    Versions are windowed per (key, time chunk); the last version of a chunk
    ends at the first version of the key's next non-empty chunk, found with a
    second window over one row per (key, chunk). A key holding a large share
    of the log is thus spread over as many tasks as it has chunks, and the
    chunk-level window is bounded by the number of chunks, not rows.
    """
    chunk = F.date_trunc(unit, F.col(valid_from)).alias("_chunk")
    d = df.withColumn("_chunk", chunk)
    within = F.lead(valid_from).over(Window.partitionBy(*keys, "_chunk").orderBy(valid_from))
    firsts = (d.groupBy(*keys, "_chunk").agg(F.min(valid_from).alias("_first"))
              .withColumn("_next_first", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_chunk")))
              .drop("_first"))
    return (d.withColumn("_within", within).join(firsts, [*keys, "_chunk"])
            .withColumn(valid_to, F.coalesce(F.col("_within"), F.col("_next_first")))
            .drop("_chunk", "_within", "_next_first"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   tiebreak: str | None = None) -> DataFrame:
    """Last row per key by ``order_col`` (ties broken by ``tiebreak``).

    A grouped ``max_by`` rather than a window: partial aggregation combines
    rows map-side, so a key holding a large share of the log does not land
    in one task.
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(order_col), F.col(tiebreak)) if tiebreak else F.col(order_col)
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others])


def snapshot_apply(history: DataFrame | None, source: DataFrame, keys: Sequence[str],
                   updated_at: str, run_ts: Column | None = None,
                   hard_delete: bool = False) -> DataFrame:
    """Apply one snapshot run of ``source`` (one row per key) to ``history``.

    Timestamp strategy: a key whose source ``updated_at`` is newer than its open
    version closes that version at the new ``updated_at`` and opens another;
    a new key opens a version; with ``hard_delete`` an open key missing from
    the source is closed at ``run_ts``. Closed history rows pass through
    untouched (no shuffle); open rows and the source meet in one join on key.
    """
    cols = source.columns
    src = (source.withColumn(UPDATED_AT, F.col(updated_at))
           .withColumn(VALID_FROM, F.col(updated_at))
           .withColumn(VALID_TO, F.lit(None).cast(source.schema[updated_at].dataType))
           .withColumn(SCD_ID, surrogate_key(*keys, updated_at)))
    out_cols = cols + [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]
    src = src.select(*out_cols)
    if history is None:
        return src

    closed = history.where(F.col(VALID_TO).isNotNull()).select(*out_cols)
    open_ = history.where(F.col(VALID_TO).isNull()).select(*out_cols)

    h = open_.select(*[F.col(c).alias(f"h_{c}") for c in out_cols])
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in out_cols])
    cond = None
    for k in keys:
        c = F.col(f"h_{k}") == F.col(f"s_{k}")
        cond = c if cond is None else cond & c
    j = h.join(s, cond, "full_outer")

    h_present = F.col(f"h_{keys[0]}").isNotNull()
    s_present = F.col(f"s_{keys[0]}").isNotNull()
    newer = s_present & h_present & (F.col(f"s_{UPDATED_AT}") > F.col(f"h_{UPDATED_AT}"))

    def row(prefix: str, valid_to: Column | None = None) -> Column:
        fields = [F.col(f"{prefix}_{c}").alias(c) for c in out_cols if c != VALID_TO]
        vt = F.col(f"{prefix}_{VALID_TO}") if valid_to is None else valid_to
        return F.struct(*fields, vt.cast(source.schema[updated_at].dataType).alias(VALID_TO))

    ts_type = source.schema[updated_at].dataType
    deleted_to = (run_ts if run_ts is not None else F.current_timestamp()).cast(ts_type)
    h_out = (F.when(newer, row("h", F.col(f"s_{UPDATED_AT}")))
             .when(h_present & ~s_present & F.lit(hard_delete), row("h", deleted_to))
             .when(h_present, row("h")))
    s_out = F.when(s_present & (~h_present | newer), row("s"))
    emitted = (j.select(F.explode(F.filter(F.array(h_out, s_out), lambda x: x.isNotNull())).alias("r"))
               .select("r.*").select(*out_cols))
    return closed.unionByName(emitted)


def compress_runs(df: DataFrame, keys: Sequence[str], order_col: str,
                  value_cols: Sequence[str], start_col: str = "effective_start_date",
                  end_col: str = "effective_end_date") -> DataFrame:
    """Periods of consecutive equal ``value_cols`` per key (null never equals null)."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    same = None
    for v in value_cols:
        c = F.lag(v).over(w) == F.col(v)
        same = c if same is None else same & c
    marked = df.withColumn("_chg", F.when(same, 0).otherwise(1))
    grouped = marked.withColumn(
        "_grp", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (grouped.groupBy(*keys, *value_cols, "_grp")
            .agg(F.min(order_col).alias(start_col), F.max(order_col).alias(end_col))
            .drop("_grp"))


def compress_runs_chunked(df: DataFrame, keys: Sequence[str], order_col: str,
                          value_cols: Sequence[str], start_col: str = "effective_start_date",
                          end_col: str = "effective_end_date", unit: str = "month") -> DataFrame:
    """``compress_runs`` that never puts one key's whole series in one task.

    Runs are found per (key, time chunk). Of each chunk one row, with its first and last
    values and its number of runs, tells which chunks go on with the run before: a
    window over a key's chunks gives a run that crosses borders the place where it
    began, and its parts are put together by that. Windows hold a
    chunk's rows or a key's chunks, never a key's rows.
    """
    by_chunk = [*keys, "_chunk"]
    w = Window.partitionBy(*by_chunk).orderBy(order_col)

    def equal(a: Sequence[str], b: Sequence[Column]) -> Column:
        same = None
        for x, y in zip(a, b, strict=True):
            e = F.col(x) == y
            same = e if same is None else same & e
        return F.coalesce(same, F.lit(False))  # null never equals null

    marked = (df.withColumn("_chunk", F.date_trunc(unit, F.col(order_col)))
              .withColumn("_chg", F.when(equal(value_cols, [F.lag(v).over(w) for v in value_cols]), 0).otherwise(1)))
    parts = (marked.withColumn("_no", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*by_chunk, *value_cols, "_no").agg(F.min(order_col).alias(start_col), F.max(order_col).alias(end_col)))
    values = F.struct(*value_cols)
    chunks = parts.groupBy(*by_chunk).agg(F.max("_no").alias("_n"), F.min_by(values, "_no").alias("_first"), F.max_by(values, "_no").alias("_last"))
    over = Window.partitionBy(*keys).orderBy("_chunk")
    goes_on = equal([f"_first.{v}" for v in value_cols], [F.lag(f"_last.{v}").over(over) for v in value_cols])
    # where the last run of a chunk began: here, unless the chunk is one run that goes on
    here = F.when(~F.col("_goes_on") | (F.col("_n") > 1), F.struct(F.col("_chunk").alias("c"), F.col("_n").alias("n")))
    chunks = (chunks.withColumn("_goes_on", goes_on)
              .withColumn("_began", F.last(here, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_before", F.when(F.col("_goes_on"), F.lag("_began").over(over)))
              .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_chunk").alias("_k_chunk"), "_before"))
    same = F.col("_chunk").eqNullSafe(F.col("_k_chunk"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    own = F.struct(F.col("_chunk").alias("c"), F.col("_no").alias("n"))
    return (parts.join(chunks, same).withColumn("_run", F.when((F.col("_no") == 1) & F.col("_before").isNotNull(), F.col("_before")).otherwise(own))
            .groupBy(*keys, *value_cols, "_run").agg(F.min(start_col).alias(start_col), F.max(end_col).alias(end_col)).drop("_run"))
