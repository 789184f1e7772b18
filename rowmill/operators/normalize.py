"""Splitting wide tables into related ones and joining them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowmill.operators.joins import attach
from rowmill.operators.mutate import assign_ids


def split_list(df: DataFrame, column: str, pattern: str = r",\s*", item: str = "item", position: str = "position") -> DataFrame:
    """One row per list element, with its position from 1."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(F.split(column, pattern)).alias("_pos", item)).select(
        *rest, (F.col("_pos") + 1).alias(position), item)


def decompose(df: DataFrame, columns: list[str], ident: str) -> tuple[DataFrame, DataFrame]:
    """(lookup of the distinct values with a surrogate key, rows that refer to it)."""
    lookup = assign_ids(df.select(*columns).distinct(), columns, ident)
    return lookup.select(ident, *columns), attach(df, lookup, columns).drop(*columns)


def split_columns(df: DataFrame, key: str, rare: list[str]) -> tuple[DataFrame, DataFrame]:
    """(often-used columns, rarely-used columns), both with the key."""
    return df.drop(*rare), df.select(key, *rare)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two frames; empty means equal as multisets."""
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("_d")).unionByName(b.select(*cols, F.lit(-1).alias("_d")))
    return both.groupBy(*cols).agg(F.sum("_d").alias("surplus")).filter("surplus <> 0")
