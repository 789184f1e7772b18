"""Typed table scans."""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The declared schemas of the input tables; nothing is inferred from data.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def scan(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """Scan one Parquet table with its declared schema, keeping only ``columns`` when given."""
    df = spark.read.schema(SCHEMAS[table]).parquet(os.path.join(folder, f"{table}.parquet"))
    return df.select(*columns) if columns else df


def literal_rows(spark: SparkSession, schema: str, rows: Iterable[tuple]) -> DataFrame:
    """A small relation written in the program text."""
    return spark.createDataFrame(list(rows), schema)


def series(spark: SparkSession, lo: int, hi: int, name: str = "n") -> DataFrame:
    """The integers lo..hi, generated in parallel."""
    return spark.range(lo, hi + 1).withColumnRenamed("id", name)


class Tables:
    """The input tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _open(self, name: str) -> DataFrame:
        return scan(self.spark, self.folder, name)

    region = cached_property(lambda self: self._open("region"))
    nation = cached_property(lambda self: self._open("nation"))
    customer = cached_property(lambda self: self._open("customer"))
    supplier = cached_property(lambda self: self._open("supplier"))
    part = cached_property(lambda self: self._open("part"))
    orders = cached_property(lambda self: self._open("orders"))
    lineitem = cached_property(lambda self: self._open("lineitem"))
    events = cached_property(lambda self: self._open("events"))


def latest(df: DataFrame, column: str, minus: str | None = None) -> Column:
    """max(column), optionally minus an interval, as a scalar subquery.

    The reports take their clock as a parameter; the bound queries use the
    newest timestamp of the table. The value reaches the scan as a pushed filter.
    """
    expr = f"max({column})" + (f" - INTERVAL {minus}" if minus else "")
    return df.agg(F.expr(expr).alias("as_of")).scalar()
