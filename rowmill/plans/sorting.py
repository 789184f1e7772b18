"""Sorts, top-k and pages. Order is shown as a row number where it is the point of the query."""

from pyspark.sql import functions as F

from rowmill.functions.money import money
from rowmill.operators import ordered, paging
from rowmill.plans.registry import query


@query("sl_01_multi_key_sort", "SL-01", sql="""
    SELECT p_partkey, row_number() OVER (ORDER BY p_brand ASC, p_retailprice DESC, p_partkey) AS pos FROM part""")
def multi_key_sort(t):
    return ordered.number_rows(t.part.select("p_partkey", "p_brand", "p_retailprice"), [],
                               ["p_brand", "-p_retailprice", "p_partkey"], "pos").select("p_partkey", "pos")


@query("sl_02_sort_by_expression", "SL-02", sql="""
    SELECT p_partkey, (p_retailprice::DECIMAL(18,2) * p_size)::DOUBLE AS worth FROM part ORDER BY worth DESC, p_partkey LIMIT 50""")
def sort_by_expression(t):
    worth = (money("p_retailprice") * F.col("p_size")).cast("double")
    return paging.top_k(t.part.select("p_partkey", worth.alias("worth")), ["-worth", "p_partkey"], 50)


@query("sl_03_nulls_last", "SL-03", sql="""
    SELECT c_custkey, k, row_number() OVER (ORDER BY k ASC NULLS LAST, c_custkey) AS pos FROM
      (SELECT c_custkey, nullif(c_nationkey, 2) AS k FROM customer)""")
def nulls_last(t):
    d = t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(2)).alias("k")).withColumn("no_k", F.col("k").isNull())
    return ordered.number_rows(d, [], ["no_k", "k", "c_custkey"], "pos").drop("no_k")


@query("sl_03_nulls_last_top", "SL-03", sql="""
    SELECT k, c_custkey FROM (SELECT c_custkey, nullif(c_nationkey, 2) AS k FROM customer) ORDER BY k DESC NULLS LAST, c_custkey LIMIT 100""")
def nulls_last_top(t):
    d = t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(2)).alias("k"))
    return d.orderBy(F.desc_nulls_last("k"), "c_custkey").limit(100)


@query("sl_04_top_k", "SL-04", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t):
    return paging.top_k(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 20)


@query("sl_05_offset_page", "SL-05", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 75")
def offset_page(t):
    return paging.offset_page(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 4, 25)


@query("sl_06_keyset_page", "SL-06", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 25")
def keyset_page(t):
    return paging.keyset_page(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 1000, 25)


@query("sl_07_any_rows", "SL-07", sql="SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 5)")
def any_rows(t):
    return t.orders.limit(5).agg(F.count("*").alias("n"))
