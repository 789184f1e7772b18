"""Normal forms and their way back, on the input tables."""

import os
import uuid

from pyspark.sql import functions as F

from rowmill.functions.money import money
from rowmill.operators.joins import bounded_broadcast
from rowmill.operators import normalize
from rowmill.plans.joining import WIDE, wide_orders
from rowmill.plans.registry import query
from rowmill.session import shared_folder


@query("nz_01_split_list", "NZ-01", sql="""
    SELECT p_partkey, unnest(range(1, len(l) + 1))::INT AS position, unnest(l) AS item FROM
      (SELECT p_partkey, string_split(p_name || ', ' || p_brand || ', ' || p_type, ', ') AS l FROM part)""")
def split_list(t):
    return normalize.split_list(t.part.select("p_partkey", F.concat_ws(", ", "p_name", "p_brand", "p_type").alias("words")), "words")


SOLD = "SELECT l_orderkey, l_linenumber, l_quantity, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey"


def sold(t):
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").alias("p_partkey"))
            .join(t.part.select("p_partkey", "p_name", "p_brand"), "p_partkey").drop("p_partkey"))


@query("nz_02_second_form", "NZ-02", sql=f"""
    WITH w AS ({SOLD}), d AS (SELECT row_number() OVER (ORDER BY p_name, p_brand) AS product_id, * FROM (SELECT DISTINCT p_name, p_brand FROM w))
    SELECT product_id, count(*) AS n, sum(l_quantity) AS quantity FROM w JOIN d ON w.p_name = d.p_name AND w.p_brand = d.p_brand GROUP BY 1""")
def second_form(t):
    _, lines = normalize.decompose(sold(t), ["p_name", "p_brand"], "product_id")
    return lines.groupBy("product_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("nz_02_second_form_lookup", "NZ-02", sql="""
    SELECT row_number() OVER (ORDER BY p_name, p_brand) AS product_id, * FROM (SELECT DISTINCT p_name, p_brand FROM part)""")
def second_form_lookup(t):
    return normalize.decompose(t.part.select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"], "product_id")[0]


@query("nz_03_third_form", "NZ-03", sql="""
    WITH w AS (SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
      d AS (SELECT row_number() OVER (ORDER BY n_name, r_name) AS place_id, * FROM (SELECT DISTINCT n_name, r_name FROM w))
    SELECT c_custkey, place_id FROM w JOIN d ON w.n_name = d.n_name AND w.r_name = d.r_name""")
def third_form(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    w = t.customer.join(bounded_broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")
    return normalize.decompose(w, ["n_name", "r_name"], "place_id")[1]


@query("nz_04_wide_read", "NZ-04", sql=f"""
    SELECT o_orderkey, c_name, p_name, (l_quantity::BIGINT * p_retailprice::DECIMAL(18,2))::DOUBLE AS line_total FROM ({WIDE})""")
def wide_read(t):
    total = F.col("l_quantity").cast("bigint") * money("p_retailprice")
    return wide_orders(t).select("o_orderkey", "c_name", "p_name", total.cast("double").alias("line_total"))


@query("nz_05_order_totals", "NZ-05", sql="""
    SELECT l_orderkey, sum(l_quantity::BIGINT * p_retailprice::DECIMAL(18,2))::DOUBLE AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def order_totals(t):
    prices = t.part.select(F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("price"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("q")).join(prices, "l_partkey")
    return lines.groupBy("l_orderkey").agg(F.sum(F.col("q") * F.col("price")).cast("double").alias("total"))


@query("nz_06_fact_table", "NZ-06", sql="""
    SELECT year(o_orderdate) AS yr, n_name, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def fact_table(t):
    """Join the dimensions once, store the facts by year, read the report from the stored table."""
    buyers = t.customer.join(bounded_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    facts = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
             .join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(buyers.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey"))
             .select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "n_name", F.year("o_orderdate").alias("yr")))
    path = os.path.join(shared_folder(t.spark), f"facts-{uuid.uuid4().hex}")
    facts.write.partitionBy("yr").parquet(path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy(F.col("yr").cast("bigint").alias("yr"), "n_name").agg(
        F.count("*").alias("n"), F.sum(money("l_extendedprice")).cast("double").alias("revenue"))


@query("nz_07_lossless", "NZ-07", sql="SELECT 0::BIGINT AS mismatches, count(*) AS n FROM lineitem")
def lossless(t):
    wide = sold(t)
    lookup, lines = normalize.decompose(wide, ["p_name", "p_brand"], "product_id")
    back = lines.join(lookup, "product_id").drop("product_id")
    return wide.agg(F.count("*").alias("n")).withColumn("mismatches", normalize.differences(wide, back).agg(F.count("*")).scalar())


@query("nz_08_split_columns", "NZ-08", sql="SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def split_columns(t):
    often, rare = normalize.split_columns(t.orders, "o_orderkey", ["o_orderpriority"])
    return (often.select("o_orderkey", "o_totalprice").join(rare.filter("o_orderpriority = '1-URGENT'"), "o_orderkey")
            .select("o_orderkey", "o_totalprice", "o_orderpriority"))
