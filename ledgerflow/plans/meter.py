"""Half-hourly meter profiles (R-8, A13, A14).

Reads are summed per (meter, quantity, day, half-hour) across registers and
their flags folded (first non-"A" flag by register order wins, else "A");
each day then becomes 48 values and 48 flags. Both steps are grouped
aggregates (map-side combined); the second collects at most 48 entries per
group, so no group can grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.adapters import Tables

SLOTS = 48  # fixed: half-hours per day
DEFAULT_FLAG = "A"


def fold_half_hours(reads: DataFrame) -> DataFrame:
    return reads.groupBy("meter_id", "qty", "read_day", "hh").agg(
        F.sum("reading").cast("decimal(38,2)").alias("value"),
        F.coalesce(F.min_by(F.when(F.col("flag") != DEFAULT_FLAG, F.col("flag")),
                            F.when(F.col("flag") != DEFAULT_FLAG, F.col("register"))),
                   F.lit(DEFAULT_FLAG)).alias("flag"))


def day_profiles(slots: DataFrame) -> DataFrame:
    """48-slot arrays per (meter, qty, day); missing slots are (0, "A")."""
    g = slots.groupBy("meter_id", "qty", "read_day").agg(
        F.map_from_entries(F.collect_list(F.struct("hh", "value"))).alias("_v"),
        F.map_from_entries(F.collect_list(F.struct("hh", "flag"))).alias("_f"))
    idx = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    zero = F.lit(0).cast("decimal(38,2)")
    return g.select(
        "meter_id", "qty", "read_day",
        F.transform(idx, lambda i: F.coalesce(F.element_at("_v", i), zero)).alias("hh_values"),
        F.transform(idx, lambda i: F.coalesce(F.element_at("_f", i), F.lit(DEFAULT_FLAG))).alias("hh_flags"))


def meter_profile_48(t: Tables) -> DataFrame:
    p = day_profiles(fold_half_hours(t.meter_reads()))
    return p.select("meter_id", "qty", "read_day",
                    F.array_join(F.col("hh_values").cast("array<string>"), ",").alias("hh_values"),
                    F.array_join("hh_flags", ",").alias("hh_flags"))
