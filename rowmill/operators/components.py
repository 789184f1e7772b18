"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowmill.session import forget, materialize

HUB_LINKS = 1000  # links of one node that one task may take ...
HUB_SHARE = 1 / 100_000  # ... unless so many nodes had them that their list would grow with the table


def _with_least(rows: DataFrame, total: int) -> DataFrame:
    """Rows (a, b) with the least b of their a as m. The rows of a node with many links are dealt to several tasks, and its least b goes to each."""
    bound = max(HUB_LINKS, int(total * HUB_SHARE))
    least = rows.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    hubs = least.where(F.col("n") > bound).select("a", F.ceil(F.col("n") / bound).cast("int").alias("parts"))  # fewer than total / bound of them
    dealt = rows.join(F.broadcast(hubs), "a", "left")
    dealt = dealt.select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    copies = F.sequence(F.lit(0), F.when(F.col("n") > bound, F.ceil(F.col("n") / bound) - 1).otherwise(0).cast("int"))
    # The plain hash join keeps the parts apart; small tables are broadcast by adaptive execution, which would gather a node's rows again.
    return dealt.join(least.select("a", "m", F.explode(copies).alias("part")).hint("shuffle_hash"), ["a", "part"]).select("a", "b", "m")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rows = _with_least(both, 2 * total)
    return rows.where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    rows = _with_least(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), total)
    moved = rows.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(rows.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b), a <> b, to rows (a, b): every node but the least of its component, and that least node.

    Each step is written to the shared folder, so a lost executor repeats one step at most; tables that nothing reads any more are deleted.
    """
    edges, before = materialize(links.select("a", "b")), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges
        before = state
        middle = materialize(_large_star(edges, state[0]))
        after = materialize(_small_star(middle, state[0]))
        forget(edges)
        forget(middle)
        edges = after
