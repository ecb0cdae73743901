"""Amount, ratio and average helpers with exact, order-independent results.

Sums of decimals are exact whatever the partitioning, so money stays
decimal until a ratio or average is formed; the final value is one
rounding (HALF_UP) of the exact quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def money_sum(c) -> Column:
    """sum of a money column, widened to decimal(38,2)."""
    return F.sum(F.col(c) if isinstance(c, str) else c).cast(MONEY_SUM)


def money_parts(c) -> tuple[Column, Column]:
    """(whole millions, the rest) of a MONEY column, both of its sign.

    Numbers of more than 18 digits are kept as BigDecimal, built and written again in each
    sum, join and exchange. The sums of these two, a bigint and a decimal(8,2), are kept as
    longs, and ``parts_total`` of them is the same total for any amounts.
    """
    a = (F.col(c) if isinstance(c, str) else c).cast(MONEY)
    millions = F.call_function("div", a.cast("bigint"), F.lit(1000000))
    return millions, (a - (millions * 1000000).cast(MONEY)).cast("decimal(8,2)")


def sum_parts(c, name: str) -> list[Column]:
    """The summed ``money_parts`` of ``c`` as columns ``name``_0 and ``name``_1."""
    return [F.sum(p).alias(f"{name}_{k}") for k, p in enumerate(money_parts(c))]


def parts_total(name: str) -> Column:
    """The MONEY_SUM of ``sum_parts``; null where nothing was summed."""
    m, r = F.col(f"{name}_0"), F.col(f"{name}_1")
    return F.when(m == 0, r.cast(MONEY_SUM)).otherwise(
        (m.cast("decimal(20,0)") * F.lit(1000000).cast("decimal(7,0)") + r).cast(MONEY_SUM))


def signed_amount(amount, kind, negative_value: str) -> Column:
    """-abs(amount) when ``kind == negative_value`` else abs(amount) (P10)."""
    a = F.col(amount) if isinstance(amount, str) else amount
    k = F.col(kind) if isinstance(kind, str) else kind
    return F.when(k == F.lit(negative_value), -F.abs(a)).otherwise(F.abs(a))


def ratio(num, den, scale: int = 4) -> Column:
    """round(num / den, scale) as double; null when den is null or 0.

    Operands are money (two decimals). As decimal(20,2) their quotient keeps
    18 decimals, so the HALF_UP rounding to ``scale`` is taken on the exact
    value before the cast to double.
    """
    n = (F.col(num) if isinstance(num, str) else num).cast("decimal(20,2)")
    d = (F.col(den) if isinstance(den, str) else den).cast("decimal(20,2)")
    q = F.try_divide(n, F.when(d != 0, d))
    return F.round(q, scale).cast("double")


def exact_avg(c, scale: int = 2) -> Column:
    """Average of a column holding values with at most ``scale`` decimals.

    Sum is exact (decimal), so the result does not depend on row order or
    partitioning; one double division gives the mean.
    """
    x = F.col(c) if isinstance(c, str) else c
    s = F.sum(x.cast(f"decimal(38,{scale})")).cast("double")
    n = F.count(x)
    return F.when(n > 0, s / n)
