"""Items that occur together."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowmill.operators.joins import skew_join
from rowmill.operators.ordered import number_rows, top_rows
from rowmill.session import materialize


BLOCK_ITEMS = 2048  # items of one basket that one task pairs with as many others
TASK_LINES = 500_000  # lines, and ...
TASK_PAIRS = 1_000_000  # ... pairs whose sums one task holds: tasks grow in number with the input, not in size
PAIRS_PER_LINE = 10  # up to this many pairs per line, making all of them is cheaper than the bounds below


def frequent_pairs(lines: DataFrame, basket: str, item: str, min_count: int, top: int) -> DataFrame:
    """The ``top`` unordered item pairs by number of line pairs in the same basket, at least ``min_count``.

    Repeated lines are first counted, so a basket holds each item once. If big
    baskets would make too many pairs, items that cannot reach the result are
    dropped before any pair is made. Pairs are summed in the tasks that make them, batch by batch, and
    then in tasks of bounded size.
    """
    lines = lines.select(F.col(basket).alias("basket"), F.col(item).alias("item"), F.lit(1).cast("bigint").alias("m"))
    counts = materialize(summed(lines, ["basket", "item"], "m", _tasks(lines.count(), TASK_LINES)))
    pairs, rows = _made(counts)
    if pairs > PAIRS_PER_LINE * rows:
        counts = _promising(counts, min_count, top)
        pairs, rows = _made(counts)
    made = line_pairs(counts, max(_tasks(rows, TASK_LINES), _tasks(pairs, TASK_PAIRS)))
    made = made.select("item_a", "item_b", (F.col("m_a") * F.col("m_b")).alias("together"))
    found = summed(made, ["item_a", "item_b"], "together", _tasks(pairs, TASK_PAIRS))
    return found.filter(F.col("together") >= min_count).orderBy(F.desc("together"), "item_a", "item_b").limit(top)


def _tasks(rows: float, each: int) -> int:
    return max(1, math.ceil(rows / each))


def summed(rows: DataFrame, keys: list[str], value: str, tasks: int) -> DataFrame:
    """Sums of ``value`` by ``keys`` in so many tasks. Rows of one key are added up batch by batch before they move, so a frequent key is few rows by then."""
    rows = rows.select(*keys, value)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([(value, "sum")])
            yield from sums.select([*keys, f"{value}_sum"]).rename_columns([*keys, value]).to_batches()

    return rows.mapInArrow(added, rows.schema).repartition(tasks, *keys).groupBy(*keys).agg(F.sum(value).alias(value))


def _sizes(counts: DataFrame) -> DataFrame:
    """(basket, k): its number of items."""
    return summed(counts.select("basket", F.lit(1).cast("bigint").alias("k")), ["basket"], "k", _tasks(counts.count(), TASK_LINES))


def _made(counts: DataFrame) -> tuple[float, float]:
    """(pairs of items in one basket, lines) of distinct (basket, item)."""
    k = F.col("k").cast("double")
    pairs, rows = _sizes(counts).agg(F.sum(k * (k - 1) / 2), F.sum(k)).first()
    return pairs or 0, rows or 0


def blocked(counts: DataFrame) -> DataFrame:
    """Add the item's ``block`` in its basket and the basket's number of ``blocks``: at most BLOCK_ITEMS items a block, in the order of the items."""
    big = materialize(_sizes(counts).filter(F.col("k") > BLOCK_ITEMS))
    small = counts.withColumns({"block": F.lit(0), "blocks": F.lit(1)})
    if big.isEmpty():
        return small
    placed = skew_join(number_rows(skew_join(counts, big.select("basket"), ["basket"], "left_semi"), ["basket"], ["item"], "_n"), big, ["basket"])
    placed = placed.select(*counts.columns, F.floor((F.col("_n") - 1) / BLOCK_ITEMS).cast("int").alias("block"),
                           F.ceil(F.col("k") / BLOCK_ITEMS).cast("int").alias("blocks"))
    return skew_join(small, big.select("basket"), ["basket"], "left_anti").unionByName(placed)


def line_pairs(counts: DataFrame, tasks: int = 0) -> DataFrame:
    """(item_a, m_a, item_b, m_b), item_a < item_b, for distinct (basket, item): the items of a big basket meet block by block, under a key for each pair of blocks.

    With ``tasks``, they meet in so many.
    """
    rows = materialize(blocked(counts))
    a = rows.select("basket", F.col("item").alias("item_a"), F.col("m").alias("m_a"), F.col("block").alias("low"),
                    F.explode(F.sequence("block", F.col("blocks") - 1)).alias("high"))
    b = rows.select("basket", F.col("item").alias("item_b"), F.col("m").alias("m_b"), F.col("block").alias("high"),
                    F.explode(F.sequence(F.lit(0), "block")).alias("low"))
    keys = ["basket", "low", "high"]
    if tasks:
        a, b = a.repartition(tasks, *keys), b.repartition(tasks, *keys)
    return a.join(b, keys).filter("item_a < item_b").select("item_a", "m_a", "item_b", "m_b")


def _promising(counts: DataFrame, min_count: int, top: int) -> DataFrame:
    """Lines of items that can still be in a result pair, by two exact bounds.

    No pair of an item exceeds the sum, over its baskets, of its count times
    the basket's highest count. And the highest pair of each basket, added up,
    gives pair counts of which ``top`` must be reached.
    """
    most = counts.groupBy("basket").agg(F.max("m").alias("most"), F.count("*").alias("items")).filter("items > 1")
    best = top_rows(counts, ["basket"], ["-m", "item"], 2).groupBy("basket").agg(
        F.min("item").alias("a"), F.max("item").alias("b"), F.min("m").alias("low"), F.max("m").alias("high"), F.count("*").alias("k"))
    leaders = best.filter("k = 2").groupBy("a", "b").agg(F.sum(F.col("low") * F.col("high")).alias("n")).orderBy(F.desc("n")).limit(top)
    reached, lowest = leaders.agg(F.count("*"), F.min("n")).first()
    needed = max(min_count, lowest) if reached == top else min_count
    bounded = skew_join(counts, most.drop("items"), ["basket"])
    useful = bounded.groupBy("item").agg(F.sum(F.col("m") * F.col("most")).alias("bound")).filter(F.col("bound") >= needed)
    return materialize(skew_join(bounded, useful.select("item"), ["item"], "left_semi").drop("most"))
