"""Window work over ordered groups of any size.

A Spark window sends each group to one task. That is right while groups are
small, so every function here first checks the largest group. Above TASK_ROWS
the rows are range-partitioned by (group, order) into slices, written once,
and each slice is scanned on its own: sums get a carry from the slices before
it, bounded frames get the few rows next to the slice border. Only values per
slice ever meet in one task.

``order`` lists column names; a leading '-' means descending. Functions that
number or add up rows need an order that is unique within the group.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from rowmill.operators import joins
from rowmill.operators.joins import attach
from rowmill.session import materialize, settled

SLICE = "_slice"
MAX_SLICES = 20_000  # values per slice meet in one task; beyond this slices grow instead, and their sorts spill


def names(order: list[str]) -> list[str]:
    return [c.lstrip("-") for c in order]


def sort_keys(order: list[str]) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


def flipped(order: list[str]) -> list[str]:
    return [c[1:] if c.startswith("-") else f"-{c}" for c in order]


def plan_slices(df: DataFrame, part: list[str]) -> tuple[DataFrame, int]:
    """(rows to go on with, number of slices); 0 slices when each group fits one task."""
    if joins.is_small(df):
        return df, 0
    df = settled(df)
    total, largest = joins.group_sizes(df, part)
    if largest <= joins.TASK_ROWS:
        return df, 0
    return df, min(MAX_SLICES, max(2, math.ceil(2 * total / joins.TASK_ROWS)))


def _sliced(df: DataFrame, part: list[str], order: list[str], n: int) -> DataFrame:
    keys = [F.col(c).asc() for c in part] + sort_keys(order)
    return materialize(df.repartitionByRange(n, *keys).withColumn(SLICE, F.spark_partition_id()))


def _group(part: list[str]) -> Column:
    return F.struct(*part) if part else F.lit(0)


def running_sums(df: DataFrame, part: list[str], order: list[str], sums: dict[str, Column], slices: int | None = None) -> DataFrame:
    """Add one running sum per entry: all rows of the group up to and including this one. ``slices`` is the number for ``plan_slices``, where known."""
    df, n = plan_slices(df, part) if slices is None else (df, slices)
    if not n:
        w = Window.partitionBy(*part).orderBy(*sort_keys(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(k) for k, c in sums.items()])
    return _running_sums_sliced(df, part, order, sums, n)


def _running_sums_sliced(df: DataFrame, part: list[str], order: list[str], sums: dict[str, Column],
                         n: int) -> DataFrame:
    values = {f"_v_{k}": c for k, c in sums.items()}
    rows = _sliced(df.withColumns(values), part, order, n).withColumn("_g", _group(part))
    per_group = rows.groupBy(SLICE, "_g").agg(*[F.sum(v).alias(v) for v in values])
    # One row per slice: its first group, and its last group with that group's sums.
    edges = per_group.groupBy(SLICE).agg(
        F.min("_g").alias("_first"), F.max("_g").alias("_last"),
        *[F.max_by(v, "_g").alias(v) for v in values])
    same_last = Window.partitionBy("_last").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0)
    by_slice = Window.orderBy(SLICE)
    edges = edges.select(SLICE, "_first", "_last", *[F.sum(v).over(same_last).alias(f"_c{v}") for v in values])
    before = F.lag("_last").over(by_slice).eqNullSafe(F.col("_first")) & (F.row_number().over(by_slice) > 1)
    carry = edges.select(SLICE, "_first", *[F.when(before, F.lag(f"_c{v}").over(by_slice)).alias(f"_c{v}")
                                            for v in values])
    rows = rows.join(F.broadcast(carry), SLICE)  # one row per slice
    w = Window.partitionBy(SLICE, "_g").orderBy(*sort_keys(order)).rowsBetween(Window.unboundedPreceding, 0)
    out = []
    for k, v in zip(sums, values):
        local = F.sum(v).over(w)
        held = F.when(F.col("_g").eqNullSafe(F.col("_first")), F.col(f"_c{v}"))
        both = F.coalesce(local, F.lit(0)) + F.coalesce(held, F.lit(0))
        out.append(F.when(local.isNull() & held.isNull(), None).otherwise(both).alias(k))
    return rows.select(*df.columns, *out)


def number_rows(df: DataFrame, part: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """ROW_NUMBER as BIGINT."""
    df, n = plan_slices(df, part)
    if not n:
        w = Window.partitionBy(*part).orderBy(*sort_keys(order))
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    return _running_sums_sliced(df, part, order, {name: F.lit(1).cast("bigint")}, n)


def peer_sums(df: DataFrame, part: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Running sums under the default RANGE frame: rows with equal order values share one result."""
    df, n = plan_slices(df, part)
    if not n:
        w = Window.partitionBy(*part).orderBy(*sort_keys(order))
        return df.select("*", *[F.sum(c).over(w).alias(k) for k, c in sums.items()])
    keys = part + names(order)
    values = {f"_v_{k}": c for k, c in sums.items()}
    points = df.withColumns(values).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    points = running_sums(points, part, order, {k: F.col(f"_v_{k}") for k in sums})
    return attach(df, points.drop(*values), keys)


def totals(df: DataFrame, part: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates over the whole group on every row: aggregate once, then join back."""
    if part:
        return attach(df, df.groupBy(*part).agg(*[c.alias(k) for k, c in aggs.items()]), part)
    return df.withColumns({k: df.agg(c.alias(k)).scalar() for k, c in aggs.items()})


def ranks(df: DataFrame, part: list[str], order: list[str], *, rank: str | None = None, dense: str | None = None,
          percent: str | None = None, cume: str | None = None) -> DataFrame:
    """RANK, DENSE_RANK, PERCENT_RANK and CUME_DIST under the given result names.

    For big groups the ranks are those of the distinct order values with their
    row counts, so a value shared by many rows is one row.
    """
    wanted = {"rank": rank, "dense": dense, "percent": percent, "cume": cume}
    wanted = {k: v for k, v in wanted.items() if v}
    df, n = plan_slices(df, part)
    if not n:
        w = Window.partitionBy(*part).orderBy(*sort_keys(order))
        native = {"rank": F.rank().over(w).cast("bigint"), "dense": F.dense_rank().over(w).cast("bigint"),
                  "percent": F.percent_rank().over(w), "cume": F.cume_dist().over(w)}
        return df.select("*", *[native[k].alias(v) for k, v in wanted.items()])
    keys = part + names(order)
    points = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    points = running_sums(points, part, order, {"_upto": F.col("_n"), "_dense": F.lit(1).cast("bigint")})
    points = totals(points, part, {"_all": F.sum("_n")})
    first = F.col("_upto") - F.col("_n") + 1
    values = {
        "rank": first,
        "dense": F.col("_dense"),
        "percent": F.when(F.col("_all") == 1, 0.0).otherwise((first - 1) / F.nullif(F.col("_all") - 1, F.lit(0))),
        "cume": F.col("_upto") / F.col("_all"),
    }
    return attach(df, points.select(*keys, *[values[k].alias(v) for k, v in wanted.items()]), keys)


def tiles(df: DataFrame, part: list[str], order: list[str], n: int, name: str = "tile") -> DataFrame:
    """NTILE(n) as BIGINT: bucket sizes differ by at most one, larger buckets first."""
    df, n_slices = plan_slices(df, part)
    if not n_slices:
        w = Window.partitionBy(*part).orderBy(*sort_keys(order))
        return df.withColumn(name, F.ntile(n).over(w).cast("bigint"))
    rows = _running_sums_sliced(df, part, order, {"_rn": F.lit(1).cast("bigint")}, n_slices)
    out = totals(rows, part, {"_all": F.count("*")})
    small = F.floor(F.col("_all") / n)
    extra = F.col("_all") % n
    in_large = extra * (small + 1)
    zero_based = F.col("_rn") - 1
    tile = F.when(zero_based < in_large, F.floor(zero_based / (small + 1)))
    tile = tile.otherwise(extra + F.floor((zero_based - in_large) / F.nullif(small, F.lit(0))))
    return out.withColumn(name, (tile + 1).cast("bigint")).drop("_rn", "_all")


def framed(df: DataFrame, part: list[str], order: list[str], exprs: dict[str, Callable[[WindowSpec], Column]],
           before: int = 0, after: int = 0) -> DataFrame:
    """Window expressions that look at most ``before`` rows back and ``after`` rows ahead (LAG, LEAD, moving frames)."""
    df, n = plan_slices(df, part)
    if not n:
        w = Window.partitionBy(*part).orderBy(*sort_keys(order))
        return df.select("*", *[f(w).alias(k) for k, f in exprs.items()])
    keys = [F.col(c).asc() for c in part] + sort_keys(order)
    rows = _sliced(df, part, order, n)
    reach = max(before, after)
    in_slice = Window.partitionBy(SLICE).orderBy(*keys)
    sizes = rows.groupBy(SLICE).agg(F.count("*").alias("_size"))
    edge = rows.withColumn("_lo", F.row_number().over(in_slice)).join(F.broadcast(sizes), SLICE)
    edge = edge.filter((F.col("_lo") <= reach) | (F.col("_lo") > F.col("_size") - reach))
    # At most 2 * reach rows per slice are left, numbered in overall order.
    edge = materialize(edge.withColumn("_at", F.row_number().over(Window.orderBy(SLICE, "_lo"))))
    spans = edge.groupBy(SLICE).agg(F.min("_at").alias("_a"), F.max("_at").alias("_b"))
    near = []
    if before:
        near.append(F.sequence(F.col("_a") - before, F.col("_a") - 1))
    if after:
        near.append(F.sequence(F.col("_b") + 1, F.col("_b") + after))
    spans = spans.select(SLICE, F.explode(F.concat(*near)).alias("_at"))
    halo = edge.drop(SLICE, "_lo", "_size").join(spans, "_at").drop("_at").withColumn("_halo", F.lit(True))
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo)
    w = Window.partitionBy(SLICE, *part).orderBy(*sort_keys(order))
    out = both.select("*", *[f(w).alias(k) for k, f in exprs.items()])
    return out.filter(~F.col("_halo")).drop("_halo", SLICE)


def top_rows(df: DataFrame, part: list[str], order: list[str], n: int, name: str = "rn") -> DataFrame:
    """The first n rows of each group. Catalyst limits each group before the shuffle, so a hot group stays small."""
    w = Window.partitionBy(*part).orderBy(*sort_keys(order))
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).filter(F.col(name) <= n)


def top_ranks(df: DataFrame, part: list[str], order: list[str], n: int, *, dense: bool = True,
              name: str = "rnk") -> DataFrame:
    """Rows whose (dense) rank is at most n, ties kept: rank the distinct values, then join them back."""
    keys = part + names(order)
    w = Window.partitionBy(*part).orderBy(*sort_keys(order))
    if dense:
        best = df.select(*keys).distinct().withColumn(name, F.row_number().over(w).cast("bigint"))
        best = best.filter(F.col(name) <= n)
    else:
        counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
        best = top_rows(counts, part, order, n, "_rn")  # n distinct values hold at least n rows
        upto = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
        best = best.withColumn(name, (upto - F.col("_n") + 1).cast("bigint"))
        best = best.filter(F.col(name) <= n).drop("_n", "_rn")
    out = joins.skew_join(df, best, keys, "inner", null_safe=True)
    return out


def first_of(df: DataFrame, part: list[str], order: list[str], columns: dict[str, str], nth: int = 1) -> DataFrame:
    """Per group, values of the nth row: result name -> source column."""
    rows = top_rows(df, part, order, nth, "_rn").filter(F.col("_rn") == nth)
    return rows.select(*part, *[F.col(c).alias(k) for k, c in columns.items()])


def medians(df: DataFrame, part: list[str], column: str, name: str = "median") -> DataFrame:
    """Exact median per group: mean of the one or two middle rows, found through counts of the distinct values."""
    points = df.filter(F.col(column).isNotNull()).groupBy(*part, column).agg(F.count("*").alias("_n"))
    points = running_sums(points, part, [column], {"_upto": F.col("_n")})
    points = totals(points, part, {"_all": F.sum("_n")})
    low, high = F.floor((F.col("_all") + 1) / 2), F.ceil((F.col("_all") + 1) / 2)
    start = F.col("_upto") - F.col("_n") + 1
    picks = (F.when(low.between(start, F.col("_upto")), 1).otherwise(0)
             + F.when(high.between(start, F.col("_upto")), 1).otherwise(0))
    points = points.withColumn("_picks", picks).filter(F.col("_picks") > 0)
    value = F.sum(F.col(column) * F.col("_picks")) / F.sum("_picks")
    return points.groupBy(*part).agg(value.alias(name))
