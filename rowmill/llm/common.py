"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SPACE = " \t\n\x0b\x0c\r"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register (spark, sf_dir) -> DataFrame under ``name``."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; where they have no such folder, ship it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Sequence[str], *names: str) -> list[str]:
    """The names, each lengthened until it differs from all columns (as Spark compares names)."""
    taken = {c.lower() for c in columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def with_text(df: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """The columns ``keep``, and after them the text under a name of its own."""
    (name,) = fresh(keep, "text")
    return df.select(*[df[c] for c in keep], df[text].cast("string").alias(name))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor).cast("bigint")).cast("int")
