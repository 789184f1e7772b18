"""Row filters and derived flags shared by many queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.functions.scalar import constant


def year_range(column: str, year: int) -> Column:
    """Year test as a half-open range on the bare column, which Parquet scans can use to skip row groups."""
    return (F.col(column) >= constant(dt.datetime(year, 1, 1))) & (F.col(column) < constant(dt.datetime(year + 1, 1, 1)))


def day_range(column: str, day: dt.date) -> Column:
    start = dt.datetime(day.year, day.month, day.day)
    return (F.col(column) >= constant(start)) & (F.col(column) < constant(start + dt.timedelta(days=1)))


def since(column: str, as_of: Column | dt.datetime, interval: str) -> Column:
    """``column`` within ``interval`` (such as '30 DAYS') before ``as_of``."""
    start = as_of if isinstance(as_of, Column) else constant(as_of)
    return F.col(column) >= start - F.expr(f"INTERVAL {interval}")


def same_text(a: Column, b: Column) -> Column:
    """Case- and accent-insensitive equality."""
    return F.collate(a, "UNICODE_CI_AI") == F.collate(b, "UNICODE_CI_AI")


def folded(c: Column) -> Column:
    """Case- and accent-insensitive grouping key."""
    return F.collate(c, "UNICODE_CI_AI")


def like_ci(c: Column, pattern: str) -> Column:
    return F.collate(c, "UTF8_LCASE").like(pattern)


def with_active_flag(df: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    return df.withColumn("is_active", F.col(deleted_at).isNull())


def active(df: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    """The view over rows that are not soft-deleted."""
    return df.filter(F.col(deleted_at).isNull())


def scoped(df: DataFrame, column: str, tenant) -> DataFrame:
    """Rows of one tenant; on a table partitioned by ``column`` only that partition is read."""
    return df.filter(F.col(column) == F.lit(tenant))


def disjoint_union(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """``first OR second`` as two scans whose second branch leaves out the first; NULL counts as not matched."""
    return df.filter(first).unionByName(df.filter(second & ~F.coalesce(first, F.lit(False))))
