"""Point-in-time (half-open interval) join to a type-2 dimension (J8).

An equi-join on the business key with a range residual, so Spark plans a hash
or sort-merge join (never a nested loop), and a hot key on the fact side is
split by AQE's skew-join handling. Each fact row is compared with the
versions of its key; when keys carry many versions, ``bucket="month"`` (or
"year") adds the time bucket to the equi-key: every version is listed under
the buckets it overlaps, so a fact row only meets the few versions of its own
bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_END = "2999-12-31"


def point_in_time_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str], at_col: str,
                       from_col: str, to_col: str, how: str = "left",
                       bucket: str | None = None) -> DataFrame:
    """fact rows with the dim version valid at ``at_col``:
    ``from <= at < coalesce(to, 2999-12-31)``."""
    d = dim.select(*[F.col(k).alias(f"_pit_{k}") for k in keys],
                   *[F.col(c) for c in dim.columns if c not in keys])
    f = fact
    if bucket:
        # open versions are listed up to the last bucket holding a fact
        last = F.trunc(fact.agg(F.max(at_col)).scalar(), bucket)
        step = F.expr("INTERVAL 1 MONTH") if bucket == "month" else F.expr("INTERVAL 1 YEAR")
        first_b = F.trunc(F.col(from_col), bucket)
        last_b = F.least(F.coalesce(F.trunc(F.date_sub(F.col(to_col), 1), bucket), last), last)
        d = d.withColumn("_pit_b", F.explode(F.sequence(first_b, F.greatest(first_b, last_b), step)))
        f = fact.withColumn("_pit_fb", F.trunc(F.col(at_col), bucket))
    cond = None
    for k in keys:
        c = f[k] == d[f"_pit_{k}"]
        cond = c if cond is None else cond & c
    if bucket:
        cond = cond & (f["_pit_fb"] == d["_pit_b"])
    upper = F.coalesce(d[to_col], F.lit(OPEN_END).cast(d.schema[to_col].dataType))
    cond = cond & (f[at_col] >= d[from_col]) & (f[at_col] < upper)
    out = f.join(d, cond, how).drop(*[f"_pit_{k}" for k in keys])
    return out.drop("_pit_b", "_pit_fb") if bucket else out


def pit_match_counts(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str], keys: Sequence[str],
                     at_col: str, from_col: str, to_col: str) -> DataFrame:
    """Number of dimension versions matching each fact row (left join, so a
    row with no version counts 0)."""
    d = dim.select(*keys, from_col, to_col).withColumn("_m", F.lit(1))
    j = point_in_time_join(fact.select(*fact_keys), d, keys, at_col, from_col, to_col, how="left")
    return j.groupBy(*fact_keys).agg(F.count("_m").alias("match_cnt"))
