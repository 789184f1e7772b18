"""Exact money: inputs are DOUBLE, sums of doubles depend on order, so add up DECIMAL(18,2)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return _col(c).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of money, returned as DOUBLE."""
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    """Exact sum over the count of non-null values, as DOUBLE; NULL for an empty group."""
    return F.sum(money(c)).cast("double") / F.nullif(F.count(_col(c)), F.lit(0))


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL where b is zero."""
    return _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))


def pct(a: str | Column, b: str | Column, digits: int = 2) -> Column:
    return F.round(ratio(a, b) * 100, digits)
