"""Parent-child tables: paths from the roots by pointer doubling, and the ancestors of a few starts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.joins import skew_join
from rowmill.session import forget, materialize


def from_roots(nodes: DataFrame, ident: str, parent: str, own: dict[str, Column],
               combine: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """All nodes that a root (NULL parent) reaches, with values combined along the path from it.

    ``own`` gives a node's own part of each value; ``combine`` joins the part
    of an upper stretch with that of the stretch below it and must be
    associative. Each round joins every open stretch with the one that ends
    where it starts, which doubles its length: a depth of D takes log2(D)
    joins. Nodes still open when stretches are longer than the table has rows
    lie in or below a cycle, which no root reaches; they are left out.
    """
    columns = nodes.columns
    state = materialize(nodes.withColumns(own).withColumn("_up", F.col(parent)))
    open_rows, length = state.filter("_up IS NOT NULL").count(), 1
    total = state.count() if open_rows else 0
    while open_rows and length <= total:
        above = state.select(F.col(ident).alias("_at"), F.col("_up").alias("_next"), *[F.col(v).alias(f"_above_{v}") for v in own])
        longer = state.filter("_up IS NOT NULL").join(above, F.col("_up") == F.col("_at"))
        longer = longer.select(*columns, *[combine[v](F.col(f"_above_{v}"), F.col(v)).alias(v) for v in own], F.col("_next").alias("_up"))
        last, state = state, materialize(state.filter("_up IS NULL").unionByName(longer))
        forget(last)
        open_rows, length = state.filter("_up IS NOT NULL").count(), 2 * length
    return state.filter("_up IS NULL").drop("_up")


def org_chart(nodes: DataFrame, ident: str, parent: str, name: str, sep: str = " → ") -> DataFrame:
    """Depth (roots are 0) and path of names."""
    return from_roots(nodes, ident, parent, {"depth": F.col(parent).isNotNull().cast("int"), "path": F.col(name)},
                      {"depth": lambda up, low: up + low, "path": lambda up, low: F.concat(up, F.lit(sep), low)})


def exploded_parts(bom: DataFrame, ident: str, parent: str, name: str, quantity: str, sep: str = " > ") -> DataFrame:
    """Bill of materials: total quantity needed (product along the path), level from 1, and path."""
    return from_roots(bom, ident, parent, {"level": F.lit(1), "total_needed": F.col(quantity).cast("bigint"), "path": F.col(name)},
                      {"level": lambda up, low: up + low, "total_needed": lambda up, low: up * low,
                       "path": lambda up, low: F.concat(up, F.lit(sep), low)})


def ancestors(nodes: DataFrame, ident: str, parent: str, starts: DataFrame) -> DataFrame:
    """For each id in the one-column frame ``starts``: the node itself (depth 0) and every ancestor.

    Round k knows all ancestors of the starts nearer than 2^k and, for every node, its 2^k-th ancestor ("jump"). One join of both with the
    jumps doubles both, so a depth of D takes log2(D) joins; one more adds the columns of the nodes. A start that climbs more levels than there are nodes is
    in or below a cycle, which is an error.
    """
    most = nodes.count()
    kind = nodes.schema[ident].dataType
    first = starts.select(F.col(starts.columns[0]).cast(kind).alias("_start")).select("_start", F.col("_start").alias("_at"), F.lit(0).alias("depth"))
    jumps = nodes.filter(F.col(parent).isNotNull()).select(F.lit(None).cast(kind).alias("_start"), F.col(ident).alias("_from"), F.col(parent).cast(kind).alias("_at"), F.lit(-1).alias("depth"))
    state = materialize(first.withColumn("_from", F.lit(None).cast(kind)).unionByName(jumps))
    length = 1
    while not state.filter("depth < 0").isEmpty():
        jump = state.filter("depth < 0").select(F.col("_from").alias("_at"), F.col("_at").alias("_to"))
        longer = skew_join(state, jump, ["_at"]).select(
            "_start", "_from", F.col("_to").alias("_at"), F.when(F.col("depth") < 0, -1).otherwise(F.col("depth") + length).alias("depth"))
        last, state = state, materialize(state.filter("depth >= 0").unionByName(longer))
        forget(last)
        length *= 2
        if length > most and not state.filter(F.col("depth") >= most).isEmpty():
            raise ValueError(f"more than {most} levels: the table has a cycle")
        if length > most:
            break
    found = state.filter("depth >= 0").select(F.col("_start").alias("start"), F.col("_at").alias(ident), "depth")
    return nodes.join(found, ident).select(*nodes.columns, "start", "depth")


def indented(name: Column, depth: Column, pad: str = "  ") -> Column:
    return F.concat(F.repeat(F.lit(pad), depth), name)
