"""Incremental loads replayed in two runs (IN1-IN8, IN11).

Each job loads the inputs up to a cutoff (run 1), then applies the
incremental step over the rest (run 2). The result must equal the one-pass
full build of the same model - that is what the oracle checks.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental as inc
from ..functions.keys import surrogate_key
from ..operators.balances import incremental_daily_balances
from ..session import ensure_checkpoint_dir
from ..sources.adapters import ORDERS_AS_OF, Tables
from . import facts, reports
from .registry import job

# Fixed cutoffs of the first runs.
PREMIUM_CUTOFF = "1998-01-01 00:00:00"
RESERVE_CUTOFF = "1998-06-30"
TXN_CUTOFF = "2001-05-01 00:00:00"
RISK_CUTOFF = "2024-01-15 12:00:00"
EXPOSURE_CUTOFF = "1999-01-15"
BALANCE_RUN1_AS_OF = dt.date(2001, 7, 25)
BALANCE_LOOKBACK_DAYS = 14
EXPOSURE_LOOKBACK_DAYS = 7


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def stored(run: DataFrame) -> DataFrame:
    """The first run's output as the stored target table the second run reads:
    written once as Parquet under spark.checkpoint.dir, which also cuts the lineage
    between the runs. The second run reads the columns and days it asks for, not all."""
    path = f"{ensure_checkpoint_dir(run.sparkSession).rstrip('/')}/ledgerflow-runs/{uuid.uuid4().hex}"
    run.write.parquet(path)
    return run.sparkSession.read.schema(run.schema).parquet(path)


@job("incr_append")
def incr_append(t: Tables) -> DataFrame:
    """fct_premium: run 2 reads postings on or after the loaded mark and appends
    the ones whose key is new (idempotent on the boundary day)."""
    run1 = stored(facts.fct_premium(t.restrict(stg_premium_transactions=F.col("posting_date") < _ts(PREMIUM_CUTOFF))))
    since = inc.past_mark(F.col("posting_date").cast("date"), run1, "premium_date", inclusive=True, as_type="date")
    run2 = facts.fct_premium(t.restrict(stg_premium_transactions=since))
    return inc.append_new(run1, run2, ["premium_sk"], boundary="premium_date")


@job("hwm_filter")
def hwm_filter(t: Tables) -> DataFrame:
    """fct_claim_reserve_snapshots: run 2 appends snapshots strictly after
    coalesce(max(snapshot_date), '1900-01-01')."""
    cut = F.col("reserve_snapshot_date") <= F.lit(RESERVE_CUTOFF).cast("date")
    run1 = stored(facts.fct_claim_reserve_snapshots(t.restrict(stg_claim_reserves_snapshots=cut)))
    newer = inc.past_mark(F.col("reserve_snapshot_date"), run1, "snapshot_date", as_type="date")
    run2 = facts.fct_claim_reserve_snapshots(t.restrict(stg_claim_reserves_snapshots=newer))
    return run1.unionByName(run2)


@job("incremental_filter")
def incremental_filter(t: Tables) -> DataFrame:
    """fct_transactions: inclusive mark on transaction_ts plus anti-join on key."""
    run1 = stored(facts.fct_transactions(t.restrict(stg_transactions=F.col("transaction_timestamp") < _ts(TXN_CUTOFF))))
    since = inc.past_mark(F.col("transaction_timestamp"), run1, "transaction_ts", inclusive=True, as_type="timestamp_ntz")
    run2 = facts.fct_transactions(t.restrict(stg_transactions=since))
    return inc.append_new(run1, run2, ["transaction_sk"], boundary="transaction_ts")


def _balance_window(t: Tables, run1: DataFrame, window_start: dt.date) -> DataFrame:
    acc = t.stg_accounts().select("account_id", "account_open_date", "opening_balance", "currency_code")
    new = incremental_daily_balances(run1, acc, facts.daily_net(t), window_start, ORDERS_AS_OF)
    return new.select(surrogate_key("account_id", "balance_date").alias("account_balance_sk"),
                      "account_id", "balance_date", "currency_code", "daily_net_amount",
                      "opening_balance", "closing_balance")


def _stored_balances(t: Tables) -> DataFrame:
    """The first run's balances, without their key: the hash is larger than the rest of a
    row, and what keeps such rows takes it from their account and day."""
    return stored(facts.fct_account_daily_balance(t, as_of=BALANCE_RUN1_AS_OF).drop("account_balance_sk"))


@job("incr_merge")
def incr_merge(t: Tables) -> DataFrame:
    """fct_account_daily_balance: run 1 to 2001-07-25, run 2 recomputes the last
    14 days to 2001-08-01 seeded with stored closings. The window recomputes every
    account's day, so whole days are replaced: no anti-join of the stored history."""
    run1 = _stored_balances(t)
    window_start = ORDERS_AS_OF - dt.timedelta(days=BALANCE_LOOKBACK_DAYS)
    older = run1.where(F.col("balance_date") < F.lit(str(window_start)).cast("date"))
    window = _balance_window(t, run1, window_start)
    return older.withColumn("account_balance_sk", surrogate_key("account_id", "balance_date")).select(*window.columns).unionByName(window)


@job("incr_merge_composite")
def incr_merge_composite(t: Tables) -> DataFrame:
    """fct_risk_score on (entity_id, entity_type, score_date): run 1 stops
    mid-day; run 2 re-reads from the last loaded day and replaces its rows."""
    run1 = stored(facts.fct_risk_score(t.restrict(stg_risk_scores=F.col("score_date") < _ts(RISK_CUTOFF))))
    mark = inc.high_water_mark(run1, "score_date")
    run2 = facts.fct_risk_score(t.restrict(
        stg_risk_scores=F.col("score_date").cast("date") >= F.lit(str(mark)).cast("date")))
    return inc.merge(run1, run2, ["entity_id", "entity_type", "score_date"], check_unique=True)


@job("incr_insert_overwrite")
def incr_insert_overwrite(t: Tables) -> DataFrame:
    """rpt_pra_exposures: run 2 recomputes from the start of the last loaded
    month and replaces those reporting periods whole."""
    run1 = stored(reports.pra_exposures(t.exposures().where(F.col("exposure_date") < F.lit(EXPOSURE_CUTOFF).cast("date"))))
    mark = inc.high_water_mark(run1, "reporting_period")
    run2 = reports.pra_exposures(t.exposures().where(F.col("exposure_date") >= F.lit(str(mark)).cast("date")))
    return inc.insert_overwrite(run1, run2, ["reporting_period"])


@job("lookback_filter")
def lookback_filter(t: Tables) -> DataFrame:
    """Credit exposure of the last 7 days before as_of: only these days are generated."""
    since = ORDERS_AS_OF - dt.timedelta(days=EXPOSURE_LOOKBACK_DAYS)
    exposure = facts.fct_credit_exposure(t, facts.balances_since(t, since))
    return inc.lookback_filter(exposure, "balance_date", ORDERS_AS_OF, days=EXPOSURE_LOOKBACK_DAYS)


@job("schema_sync")
def schema_sync(t: Tables) -> DataFrame:
    """Reserve-snapshot fact loaded once with an older column set (no
    customer_id, an extra load_batch), then with the current one: old rows
    are aligned to the new columns."""
    cut = F.lit(RESERVE_CUTOFF).cast("date")
    day = F.col("reserve_snapshot_date")
    old = facts.fct_claim_reserve_snapshots(t.restrict(stg_claim_reserves_snapshots=day <= cut))
    old = stored(old.drop("customer_id").withColumn("load_batch", F.lit("v1")))
    new = facts.fct_claim_reserve_snapshots(t.restrict(stg_claim_reserves_snapshots=day > cut))
    return inc.schema_sync(old, new)


SPENDING_CUTOFF = "1998-01-01 00:00:00"


@job("incr_spending")
def incr_spending(t: Tables) -> DataFrame:
    """customer_spending_analysis merged on its five grouping columns: rows
    updated after the mark touch some groups, and those groups are recomputed
    from all their rows (a partial group never replaces a whole one). One pass over the
    rows tells which groups are touched and recomputes them: a group with a null key is
    never one of them."""
    src = t.retail_daily_transactions()
    changed = F.col("last_updated_at") >= _ts(SPENDING_CUTOFF)
    run1 = stored(reports.spending(src.where(F.col("last_updated_at") < _ts(SPENDING_CUTOFF))))
    whole = src.dropna(subset=reports.SPENDING_KEYS)
    run2 = reports.spending(whole, F.max(changed).alias("_touched")).where("_touched").drop("_touched")
    return inc.merge_once(run1, run2, reports.SPENDING_KEYS)


@job("incr_balance_scd2")
def incr_balance_scd2(t: Tables) -> DataFrame:
    """Balance periods after the 14-day balance increment: closed periods stay, the
    period that reaches the window and the window's days are compressed anew."""
    run1_balances = _stored_balances(t)
    run1 = stored(facts.dim_account_balance_scd2(t, run1_balances))
    window_start = ORDERS_AS_OF - dt.timedelta(days=BALANCE_LOOKBACK_DAYS)
    window = _balance_window(t, run1_balances, window_start)
    kept, rebuilt = facts.balance_periods_increment(run1, window, window_start)
    periods = kept.select(*rebuilt.columns).unionByName(rebuilt)
    return facts.balance_periods_rows(periods, F.lit(str(ORDERS_AS_OF)).cast("date"))


LOSS_RATIO_LOOKBACK_MONTHS = 12


@job("incr_loss_ratio")
def incr_loss_ratio(t: Tables) -> DataFrame:
    """fct_loss_ratio: run 1 saw claims and premiums up to the start of the
    12-month lookback; run 2 recomputes the lookback months (and the
    no-claim rows, whose period is null) and overwrites those periods."""
    start = F.trunc(F.add_months(F.lit(str(ORDERS_AS_OF)).cast("date"), -LOSS_RATIO_LOOKBACK_MONTHS), "month")
    before = t.restrict(stg_claims=F.col("claim_reported_date").cast("date") < start,
                        stg_premium_transactions=F.col("posting_date").cast("date") < start)
    run1 = stored(facts.fct_loss_ratio(before))
    since = t.restrict(stg_claims=F.col("claim_reported_date").cast("date") >= start,
                       stg_premium_transactions=F.col("posting_date").cast("date") >= start)
    months = facts.fct_loss_ratio(since).where(F.col("period_month").isNotNull())
    # policies without any claim: those the first run found without one and the window neither
    idle = run1.where(F.col("period_month").isNull()).join(months.select("policy_id").distinct(), "policy_id", "left_anti")
    return run1.where(F.col("period_month") < start).unionByName(months).unionByName(idle)
