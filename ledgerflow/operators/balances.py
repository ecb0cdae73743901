"""Daily balance spine and running balances (J7, W2, W3).

Plan shape (one exchange of the spine, none after):

* accounts are hash-partitioned on ``account_id`` (a shuffle of the account
  table only) and the day spine is generated in place with
  ``explode(sequence(open_date, as_of))`` - a narrow ``Generate`` that keeps
  that partitioning, so the spine itself (accounts x days, the largest
  relation) is never shuffled;
* transactions are first summed per (account, day) - partial aggregation, so
  an account holding a large share of transactions is combined map-side and
  contributes at most one row per day - and then hash-partitioned the same way;
* the two are unioned (same partitioning is kept) and one ordered window per
  account yields cumulative, opening and closing balances.

Nothing is collected and no range join (BroadcastNestedLoopJoin) is planned. The
spine is generated after its exchange, where AQE cannot split it: its number of
partitions is ``partitions`` or ``spark.sql.shuffle.partitions``, which a cluster
sizes as accounts x days / a few million rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def account_day_spine(accounts: DataFrame, open_col: str, as_of: dt.date | str,
                      date_col: str = "balance_date", key: str = "account_id",
                      partitions: int | None = None) -> DataFrame:
    """One row per account and day from the open date to ``as_of`` inclusive."""
    n = partitions or shuffle_partitions(accounts.sparkSession)
    end = F.lit(str(as_of)).cast("date")
    # sequence() would count down for an account opened after as_of: no rows instead
    a = accounts.where(F.col(open_col) <= end).repartition(n, key)
    return a.withColumn(date_col, F.explode(F.sequence(F.col(open_col), end)))


def daily_balances(accounts: DataFrame, daily_amounts: DataFrame, as_of: dt.date | str,
                   key: str = "account_id", open_col: str = "account_open_date",
                   opening_col: str = "opening_balance", amount_col: str = "daily_net_amount",
                   date_col: str = "balance_date", keep: tuple[str, ...] = ("currency_code",),
                   partitions: int | None = None) -> DataFrame:
    """Running balances over the spine.

    ``accounts``: one row per account with ``open_col``, ``opening_col`` and
    ``keep`` columns. ``daily_amounts``: (key, date_col, amount_col), at most
    one row per account and day. Amounts dated before the open date or after
    ``as_of`` do not enter any balance.

    Output: key, date_col, keep..., daily_net_amount, opening_balance,
    closing_balance; opening of the first day is the account's opening balance.
    """
    n = partitions or shuffle_partitions(accounts.sparkSession)
    money = "decimal(38,2)"
    spine = (account_day_spine(accounts, open_col, as_of, date_col, key, n)
             .select(key, date_col, *keep, F.col(opening_col).cast(money).alias("_opening"),
                     F.lit(None).cast(money).alias("_amt"), F.lit(1).alias("_spine")))
    tx = (daily_amounts.repartition(n, key)
          .select(key, date_col, *[F.lit(None).alias(c) for c in keep],
                  F.lit(None).cast(money).alias("_opening"),
                  F.col(amount_col).cast(money).alias("_amt"), F.lit(0).alias("_spine")))
    u = spine.unionByName(tx)

    per_key = Window.partitionBy(key)
    # transactions of a day sort before that day's spine row
    ordered = Window.partitionBy(key).orderBy(date_col, "_spine")
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    first_day = F.min(F.when(F.col("_spine") == 1, F.col(date_col))).over(per_key)
    eff = F.when((F.col("_spine") == 0) & (F.col(date_col) >= first_day), F.col("_amt")).otherwise(
        F.lit(0).cast(money))
    with_cum = u.withColumn("_eff", eff).withColumn("_cum", F.sum("_eff").over(running))

    days = with_cum.where(F.col("_spine") == 1)
    by_day = Window.partitionBy(key).orderBy(date_col)
    closing = (F.col("_opening") + F.col("_cum")).cast(money)
    return days.select(
        key, date_col, *keep,
        (F.col("_cum") - F.lag("_cum", 1, 0).over(by_day)).cast(money).alias("daily_net_amount"),
        F.coalesce(F.lag(closing).over(by_day), F.col("_opening")).cast(money).alias("opening_balance"),
        closing.alias("closing_balance"),
    )


def daily_balances_by_month(accounts: DataFrame, daily_amounts: DataFrame, as_of: dt.date | str,
                            key: str = "account_id", open_col: str = "account_open_date",
                            opening_col: str = "opening_balance", amount_col: str = "daily_net_amount",
                            date_col: str = "balance_date", keep: tuple[str, ...] = ("currency_code",),
                            partitions: int | None = None) -> DataFrame:
    """``daily_balances`` in two levels, for keys with very many days.

    Amounts are summed per key and month; a running sum over a key's months (one row
    each: 1,200 for a century) gives every month its opening balance; days are generated and
    summed within each month. (key, month) is what the days are dealt by, so one key's
    history is spread over as many tasks as it has months, and no window holds
    more than a month of it. Same rows as ``daily_balances``.
    """
    n = partitions or shuffle_partitions(accounts.sparkSession)
    money = "decimal(38,2)"
    end = F.lit(str(as_of)).cast("date")
    life = accounts.where(F.col(open_col) <= end).select(key, F.col(open_col).alias("_opened"), F.col(opening_col).cast(money).alias("_opening"), *keep)
    amounts = (daily_amounts.join(life.select(key, "_opened"), key)
               .where((F.col(date_col) >= F.col("_opened")) & (F.col(date_col) <= end))
               .select(key, date_col, F.col(amount_col).cast(money).alias("_amt"), F.trunc(date_col, "month").alias("_month")))
    sums = amounts.groupBy(key, "_month").agg(F.sum("_amt").cast(money).alias("_net"))
    months = life.withColumn("_month", F.explode(F.sequence(F.trunc("_opened", "month"), F.trunc(end, "month"), F.expr("interval 1 month"))))
    earlier = Window.partitionBy(key).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    begun = (months.join(sums, [key, "_month"], "left")
             .withColumn("_begin", (F.col("_opening") + F.coalesce(F.sum("_net").over(earlier), F.lit(0))).cast(money)))
    days = (begun.repartition(n, key, "_month")
            .withColumn(date_col, F.explode(F.sequence(F.greatest("_month", "_opened"), F.least(F.last_day("_month"), end))))
            .select(key, "_month", date_col, *keep, "_begin", F.lit(None).cast(money).alias("_amt"), F.lit(1).alias("_day")))
    moved = (amounts.repartition(n, key, "_month")
             .select(key, "_month", date_col, *[F.lit(None).alias(c) for c in keep], F.lit(None).cast(money).alias("_begin"), "_amt", F.lit(0).alias("_day")))
    running = Window.partitionBy(key, "_month").orderBy(date_col, "_day").rowsBetween(Window.unboundedPreceding, 0)
    summed = days.unionByName(moved).withColumn("_cum", F.sum(F.coalesce("_amt", F.lit(0).cast(money))).over(running))
    by_day = Window.partitionBy(key, "_month").orderBy(date_col)
    closing = (F.col("_begin") + F.col("_cum")).cast(money)
    return summed.where("_day = 1").select(
        key, date_col, *keep,
        (F.col("_cum") - F.lag("_cum", 1, 0).over(by_day)).cast(money).alias("daily_net_amount"),
        F.coalesce(F.lag(closing).over(by_day), F.col("_begin")).cast(money).alias("opening_balance"),
        closing.alias("closing_balance"))


def incremental_daily_balances(previous: DataFrame, accounts: DataFrame, daily_amounts: DataFrame,
                               window_start: dt.date, as_of: dt.date, key: str = "account_id",
                               open_col: str = "account_open_date", opening_col: str = "opening_balance",
                               date_col: str = "balance_date", keep: tuple[str, ...] = ("currency_code",),
                               partitions: int | None = None) -> DataFrame:
    """Recompute balances from ``window_start`` to ``as_of`` only.

    Each account is seeded with its stored closing balance of the day before
    the window (accounts opened inside the window start from their opening
    balance), so the recomputed rows equal a full rebuild; only amounts dated
    inside the window are read.
    """
    ws = F.lit(str(window_start)).cast("date")
    carry = (previous.where(F.col(date_col) == F.date_sub(ws, 1))
             .select(key, F.col("closing_balance").alias("_carry")))
    acc = (accounts.join(carry, key, "left")
           .withColumn("_open_w", F.greatest(F.col(open_col), ws))
           .withColumn("_opening_w", F.when(F.col(open_col) >= ws, F.col(opening_col))
                       .otherwise(F.col("_carry")))
           .where(F.col("_open_w") <= F.lit(str(as_of)).cast("date")))
    amounts = daily_amounts.where(F.col(date_col) >= ws)
    return daily_balances(acc, amounts, as_of, key=key, open_col="_open_w", opening_col="_opening_w",
                          date_col=date_col, keep=keep, partitions=partitions)


def window_balances(accounts: DataFrame, daily_amounts: DataFrame, since: dt.date | str, as_of: dt.date | str,
                    key: str = "account_id", open_col: str = "account_open_date",
                    opening_col: str = "opening_balance", amount_col: str = "daily_net_amount",
                    date_col: str = "balance_date", keep: tuple[str, ...] = ("currency_code",),
                    partitions: int | None = None) -> DataFrame:
    """``daily_balances`` from ``since`` on, without generating the days before.

    What an account moved between its opening and the window is one sum per
    account, added to the opening balance; the spine starts with the window.
    """
    start = F.lit(str(since)).cast("date")
    opened = accounts.select(key, F.col(open_col).alias("_opened"))
    moved = (daily_amounts.where(F.col(date_col) < start).join(opened, key)
             .where(F.col(date_col) >= F.col("_opened"))
             .groupBy(key).agg(F.sum(amount_col).alias("_moved")))
    seeded = (accounts.join(moved, key, "left")
              .withColumn("_open_w", F.greatest(F.col(open_col), start))
              .withColumn("_opening_w", F.col(opening_col) + F.coalesce("_moved", F.lit(0))))
    return daily_balances(seeded, daily_amounts.where(F.col(date_col) >= start), as_of, key=key, open_col="_open_w",
                          opening_col="_opening_w", amount_col=amount_col, date_col=date_col, keep=keep, partitions=partitions)
