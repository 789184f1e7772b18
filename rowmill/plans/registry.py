"""Registry of bound queries: each has a name, the ids it covers, and (mostly) an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rowmill.sources.scan import Tables


@dataclass(frozen=True)
class Bound:
    name: str
    ids: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None


CATALOG: dict[str, Bound] = {}


def query(name: str, *ids: str, sql: str | None = None):
    """Register a function Tables -> DataFrame under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Bound(name, ids, build, sql)
        return build

    return register


def runner(bound: Bound) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bound.build(Tables(spark, sf_dir))

    run.__name__ = bound.name
    return run
