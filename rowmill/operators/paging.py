"""Sorting and pages. Every page needs a unique sort key, else rows may repeat or be lost between pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.ordered import sort_keys


def top_k(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """Sort and limit in one step: each task keeps k rows, no full sort."""
    return df.orderBy(*sort_keys(order)).limit(k)


def offset_page(df: DataFrame, order: list[str], page: int, size: int) -> DataFrame:
    return df.orderBy(*sort_keys(order)).offset((page - 1) * size).limit(size)


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The page after a known key; the filter is pushed to the scan, so cost does not grow with the page number."""
    return df.filter(F.col(key) > F.lit(after)).orderBy(key).limit(size)


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE of the row at ``position`` (from 1) among ``rows``: the first ``rows % tiles`` tiles hold one row more."""
    size, more = F.floor(rows / tiles), rows % tiles
    big = more * (size + 1)
    low = F.floor((position - 1) / (size + 1)) + 1
    high = more + F.floor((position - 1 - big) / F.greatest(size, F.lit(1))) + 1
    return F.when(position <= big, low).otherwise(high).cast("int")
