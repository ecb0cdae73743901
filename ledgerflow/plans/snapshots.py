"""History snapshots (H1-H7) applied run by run.

A snapshot run compares the source's *current state* (one row per key) with
the open versions of the stored history. The registered queries replay a
change log as three runs: the state at each run is the latest change per key
up to the run time (a grouped max_by, skew-safe), and each run is one
``snapshot_apply`` (one join on key). The final history must equal the
version chain built in one pass from the distinct states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scd2 import VALID_FROM, VALID_TO, close_versions_chunked, latest_per_key, snapshot_apply
from ..sources.adapters import Tables

# Fixed run times of the replays (order-derived and event-derived logs).
ORDER_RUNS = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2001-08-02 00:00:00")
# Price changes carry ship dates, which go on after the last order.
PRICE_RUNS = (*ORDER_RUNS[:2], "2001-12-31 00:00:00")
EVENT_RUNS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-01-31 00:00:00")
# Orders purged from the source (hard deletes) and orders settled later.
PURGED_BEFORE = "1996-01-01"
SETTLED_AT = "1999-06-01 00:00:00"


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def state_at(changes: DataFrame, keys: Sequence[str], updated_at: str, run_ts: str,
             tiebreak: str, columns: Sequence[str]) -> DataFrame:
    """Source table as of ``run_ts``: latest change per key up to that time."""
    upto = changes.where(F.col(updated_at) <= _ts(run_ts))
    return latest_per_key(upto, list(keys), updated_at, tiebreak).select(*columns)


# Runs applied before the history is checkpointed: each run adds a join to
# the plan, so a long replay cuts lineage in the shared checkpoint folder.
CHECKPOINT_EVERY = 4


def replay(states: Sequence[tuple[DataFrame, str]], keys: Sequence[str], updated_at: str,
           hard_delete: bool = False, checkpoint_every: int = CHECKPOINT_EVERY) -> DataFrame:
    """Apply snapshot runs in order; each state is (source frame, run time)."""
    hist = None
    for i, (src, run_ts) in enumerate(states, start=1):
        hist = snapshot_apply(hist, src, keys, updated_at, _ts(run_ts), hard_delete)
        if checkpoint_every and i % checkpoint_every == 0 and i < len(states):
            hist = hist.checkpoint(eager=True)  # reliable: written under spark.checkpoint.dir
    return hist


def replay_change_log(changes: DataFrame, keys: Sequence[str], updated_at: str, tiebreak: str,
                      columns: Sequence[str], runs: Sequence[str]) -> DataFrame:
    return replay([(state_at(changes, keys, updated_at, r, tiebreak, columns), r) for r in runs],
                  keys, updated_at)


ADDRESS_COLS = ["customer_id", "address_line1", "address_line2", "city", "state", "postal_code",
                "country", "last_updated_at"]


def snap_customer_address(t: Tables) -> DataFrame:
    return replay_change_log(t.crm_customer_changes(), ["customer_id"], "last_updated_at",
                             "change_id", ADDRESS_COLS, ORDER_RUNS)


def snap_employee_role(t: Tables) -> DataFrame:
    return replay_change_log(t.hr_employee_roles(), ["employee_id"], "role_last_updated", "change_id",
                             ["employee_id", "role", "department", "role_last_updated"], EVENT_RUNS)


def snap_product_price(t: Tables) -> DataFrame:
    return replay_change_log(t.product_prices(), ["product_code"], "last_updated_at", "change_id",
                             ["product_code", "price", "last_updated_at"], PRICE_RUNS)


ORDER_COLS = ["order_id", "customer_id", "order_date", "order_status", "payment_status",
              "order_amount", "currency", "updated_at"]


def order_state(t: Tables, run_ts: str) -> DataFrame:
    """Orders source at a run: orders placed before it; fulfilled orders placed before
    1996 are purged from the second run of the replay on; open orders placed before
    1999 are settled (status F, PAID) at 1999-06-01."""
    purged = (F.col("order_status") == "F") & (F.col("order_date") < F.lit(PURGED_BEFORE).cast("date"))
    settled = (F.col("order_status") == "O") & (F.col("order_date") < F.lit("1999-01-01").cast("date"))
    s = t.stg_orders().where(F.col("updated_at") < _ts(run_ts))
    if run_ts >= ORDER_RUNS[1]:
        s = s.where(~purged)
    if run_ts > SETTLED_AT:
        st = F.col("_settled")
        s = (s.withColumn("_settled", settled)
             .withColumn("order_status", F.when(st, "F").otherwise(F.col("order_status")))
             .withColumn("payment_status", F.when(st, "PAID").otherwise(F.col("payment_status")))
             .withColumn("updated_at", F.when(st, _ts(SETTLED_AT)).otherwise(F.col("updated_at"))))
    return s.select(*ORDER_COLS)


def order_states(t: Tables) -> list[tuple[DataFrame, str]]:
    """The source at each run of the replay."""
    return [(order_state(t, run), run) for run in ORDER_RUNS]


def snap_orders(t: Tables) -> DataFrame:
    """Order history with hard-delete invalidation (H5)."""
    return replay(order_states(t), ["order_id"], "updated_at", hard_delete=True)


def snap_hard_delete(t: Tables) -> DataFrame:
    """Versions closed because their key left the source (H2): closed rows of
    keys that have no open version."""
    h = snap_orders(t)
    # one aggregate per key over the history instead of a second copy of it: a key's
    # versions are a handful, kept only where none is open
    version = F.struct(*h.columns)
    per_key = (h.groupBy("order_id").agg(F.bool_or(F.col(VALID_TO).isNull()).alias("open"), F.collect_list(version).alias("versions"))
               .where(~F.col("open")))
    return per_key.select(F.explode("versions").alias("v")).select("v.*")


def snap_from_change_log(t: Tables) -> DataFrame:
    """Bulk history from a change log (H7): every distinct change time of a key
    opens a version that ends at the next one. Reduced first to one row per
    (key, change time), then chained per (key, month) so no task holds a
    key's whole history."""
    ch = t.crm_customer_changes()
    per_time = latest_per_key(ch, ["customer_id", "last_updated_at"], "change_id")
    hist = close_versions_chunked(per_time.withColumn(VALID_FROM, F.col("last_updated_at")),
                                  ["customer_id"], VALID_FROM, VALID_TO, unit="month")
    return hist.select(*ADDRESS_COLS, VALID_FROM, VALID_TO)
