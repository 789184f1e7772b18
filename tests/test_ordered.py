"""The sliced forms must equal Spark's own window functions, hot groups and ties included."""

import pytest
from pyspark.sql import Window, functions as F

from rowmill.operators import joins, ordered


@pytest.fixture(scope="module")
def rows(spark):
    # Group 'a' holds two thirds of the rows; NULL is a group; order values repeat.
    df = spark.range(600).select(
        F.col("id"),
        F.when(F.col("id") % 3 < 2, "a").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 11)).alias("g"),
        F.when(F.col("id") % 13 == 0, None).otherwise(F.pmod(F.col("id") * 37, F.lit(23))).alias("v"),
        (F.pmod(F.col("id") * 7919, F.lit(101))).alias("x"))
    return df.cache()


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left = sorted(map(repr, a.select(*cols).collect()))
    right = sorted(map(repr, b.select(*cols).collect()))
    assert left == right


PARTS = [["g"], []]


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("order", [["v", "id"], ["-v", "id"]])
def test_running_and_numbers(rows, small_tasks, part, order):
    assert ordered.plan_slices(rows, part)[1] > 2
    w = Window.partitionBy(*part).orderBy(*ordered.sort_keys(order))
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    same(ordered.running_sums(rows, part, order, {"s": F.col("x"), "sv": F.col("v")}),
         rows.select("*", F.sum("x").over(wr).alias("s"), F.sum("v").over(wr).alias("sv")))
    same(ordered.number_rows(rows, part, order), rows.withColumn("rn", F.row_number().over(w).cast("bigint")))
    same(ordered.tiles(rows, part, order, 7), rows.withColumn("tile", F.ntile(7).over(w).cast("bigint")))


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("order", [["v"], ["-v"]])
def test_ranks_with_ties(rows, small_tasks, part, order):
    w = Window.partitionBy(*part).orderBy(*ordered.sort_keys(order))
    got = ordered.ranks(rows, part, order, rank="r", dense="d", percent="p", cume="c")
    want = rows.select("*", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"),
                       F.percent_rank().over(w).alias("p"), F.cume_dist().over(w).alias("c"))
    same(got, want)
    same(ordered.peer_sums(rows, part, order, {"s": F.col("x")}), rows.withColumn("s", F.sum("x").over(w)))
    same(ordered.top_ranks(rows, part, order, 3), rows.withColumn("rnk", F.dense_rank().over(w).cast("bigint"))
         .filter("rnk <= 3"))
    same(ordered.top_ranks(rows, part, order, 9, dense=False),
         rows.withColumn("rnk", F.rank().over(w).cast("bigint")).filter("rnk <= 9"))


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("before,after", [(1, 0), (2, 2), (0, 3), (90, 90)])
def test_bounded_frames(rows, small_tasks, part, before, after):
    exprs = {"s": lambda w: F.sum("x").over(w.rowsBetween(-before, after))}
    if before:
        exprs["lag"] = lambda w: F.lag("x").over(w)
    if after:
        exprs["lead"] = lambda w: F.lead("id").over(w)
    w = Window.partitionBy(*part).orderBy("v", "id")
    same(ordered.framed(rows, part, ["v", "id"], exprs, before, after),
         rows.select("*", *[f(w).alias(k) for k, f in exprs.items()]))


def test_totals_and_medians(rows, small_tasks):
    w = Window.partitionBy("g")
    same(ordered.totals(rows, ["g"], {"t": F.sum("x"), "n": F.count("*")}),
         rows.select("*", F.sum("x").over(w).alias("t"), F.count("*").over(w).alias("n")))
    same(ordered.medians(rows, ["g"], "x"), rows.groupBy("g").agg(F.expr("percentile(x, 0.5)").alias("median")))
    same(ordered.medians(rows, [], "x"), rows.agg(F.expr("percentile(x, 0.5)").alias("median")))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join(rows, small_tasks, how):
    facts = rows.filter("id % 5 = 0").select("g", F.col("x").alias("y"))
    same(joins.skew_join(rows, facts, ["g"], how), rows.join(facts, ["g"], how))


def test_not_in(spark, rows):
    listed = rows.filter("g = 'a'").select("g")
    assert joins.not_in(rows, "g", listed, "g").count() == rows.filter("g <> 'a'").count()
    assert joins.not_in(rows, "g", rows.select("g"), "g").count() == 0
    assert joins.not_in(rows, "g", listed.limit(0), "g").count() == 600
