"""Partition labels, pruned reads and shard routing."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from rowmill.functions.money import money
from rowmill.operators.joins import bounded_broadcast
from rowmill.operators import layout
from rowmill.plans.registry import query
from rowmill.session import shared_folder
from rowmill.sources.sink import truncate
from rowmill.sources.versioned import VersionedTable

YEARS = """CASE WHEN year(o_orderdate) < 1999 THEN 'p1998' WHEN year(o_orderdate) < 2000 THEN 'p1999' WHEN year(o_orderdate) < 2001 THEN 'p2000'
    ELSE 'p_future' END"""


def labelled(t):
    return t.orders.withColumn("label", layout.year_bucket(F.col("o_orderdate"), 1998, 2000))


@query("pt_01_year_partitions", "PT-01", "PT-10", sql=f"SELECT {YEARS} AS label, count(*) AS row_count FROM orders GROUP BY 1")
def year_partitions(t):
    return layout.partition_counts(labelled(t), F.col("label"))


QUARTERS = [("p_2024_w1", dt.datetime(2024, 1, 8)), ("p_2024_w2", dt.datetime(2024, 1, 15)), ("p_2024_w3", dt.datetime(2024, 1, 22))]


@query("pt_02_range_partitions", "PT-02", sql="""
    SELECT CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 'p_2024_w1' WHEN ts < TIMESTAMP '2024-01-15' THEN 'p_2024_w2'
      WHEN ts < TIMESTAMP '2024-01-22' THEN 'p_2024_w3' ELSE 'p_future' END AS label, count(*) AS row_count FROM events GROUP BY 1""")
def range_partitions(t):
    return layout.partition_counts(t.events, layout.range_bucket(F.col("ts"), QUARTERS))


@query("pt_03_date_partitions", "PT-03", sql="""
    SELECT l_returnflag, CASE WHEN l_shipdate::DATE < DATE '1997-04-01' THEN 'q1' WHEN l_shipdate::DATE < DATE '1997-07-01' THEN 'q2' ELSE 'later' END AS label,
      count(*) AS n FROM lineitem GROUP BY ALL""")
def date_partitions(t):
    label = layout.range_bucket(F.to_date("l_shipdate"), [("q1", dt.date(1997, 4, 1)), ("q2", dt.date(1997, 7, 1))], "later")
    return t.lineitem.groupBy("l_returnflag", label.alias("label")).agg(F.count("*").alias("n"))


@query("pt_04_list_partitions", "PT-04", sql="""
    SELECT CASE WHEN n_regionkey IN (0, 1) THEN 'west' WHEN n_regionkey IN (2, 3) THEN 'east' ELSE 'rejected' END AS label, count(*) AS n
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def list_partitions(t):
    d = t.customer.join(bounded_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    good, rejects = layout.list_bucket(d, "n_regionkey", {"west": [0, 1], "east": [2, 3]})
    return good.unionByName(rejects.withColumn("label", F.lit("rejected"))).groupBy("label").agg(F.count("*").alias("n"))


@query("pt_05_hash_partitions", "PT-05", sql="SELECT o_orderkey % 8 AS label, count(*) AS row_count FROM orders GROUP BY 1")
def hash_partitions(t):
    return layout.partition_counts(t.orders, layout.hash_bucket(F.col("o_orderkey"), 8))


@query("pt_06_key_partitions", "PT-06", sql="""
    SELECT (('0x' || substr(md5(c_name), 1, 8))::BIGINT % 4)::INT AS label, count(*) AS row_count FROM customer GROUP BY 1""")
def key_partitions(t):
    return layout.partition_counts(t.customer, layout.key_bucket(F.col("c_name"), 4))


@query("src_19_truncate_partition", "SRC-19", sql="""
    SELECT 'p' || least(greatest(year(o_orderdate), 1998), 2000) AS label, count(*) AS row_count FROM orders WHERE year(o_orderdate) <> 1999 AND year(o_orderdate) < 2001 GROUP BY 1""")
def truncate_partition(t):
    """Orders stored by year; one partition, and then the catch-all, is emptied."""
    path = os.path.join(shared_folder(t.spark), f"orders-by-year-{uuid.uuid4().hex}")
    layout.write_partitioned(labelled(t), path, "label")
    for label in ("p1999", "p_future"):
        truncate(t.spark, path, f"label={label}")
    return layout.partition_counts(t.spark.read.parquet(path), F.col("label"))


@query("pt_07_pruned_read", "PT-07", sql="""
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-03-01' AND o_orderdate < TIMESTAMP '2000-01-01'""")
def pruned_read(t):
    path = os.path.join(shared_folder(t.spark), f"orders-by-year-{uuid.uuid4().hex}")
    layout.write_partitioned(labelled(t), path, "label")
    rows = layout.read_years(t.spark, path, "o_orderdate", "label", 1998, 2000, dt.datetime(1999, 3, 1), dt.datetime(2000, 1, 1))
    return rows.select("o_orderkey", "o_orderdate")


@query("pt_08_split_catch_all", "PT-08", sql="""
    SELECT CASE WHEN year(o_orderdate) < 1999 THEN 'p1998' WHEN year(o_orderdate) < 2000 THEN 'p1999' WHEN year(o_orderdate) < 2001 THEN 'p2000'
      WHEN year(o_orderdate) < 2002 THEN 'p2001' ELSE 'p_future' END AS label, count(*) AS row_count FROM orders GROUP BY 1""")
def split_catch_all(t):
    """Orders stored by year; the years after 2000 leave the catch-all. One switch of the version moves them, so a failure changes nothing."""
    table = VersionedTable(t.spark, os.path.join(shared_folder(t.spark), f"orders-by-year-{uuid.uuid4().hex}"), "label")
    table.create(labelled(t))
    table.split("p_future", layout.year_bucket(F.col("o_orderdate"), 2001, 2001))
    return layout.partition_counts(table.read(), F.col("label"))


@query("pt_09_archive", "PT-09", sql="""
    SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'archived' ELSE 'kept' END AS part, count(*) AS n, min(o_orderdate) AS first_date,
      max(o_orderdate) AS last_date FROM orders GROUP BY 1""")
def archive(t):
    kept, old = layout.split_archive(t.orders, "o_orderdate", dt.datetime(1998, 1, 1))
    both = kept.withColumn("part", F.lit("kept")).unionByName(old.withColumn("part", F.lit("archived")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@query("pt_11_hash_shards", "PT-11", sql="SELECT user_id, user_id % 4 AS shard, count(*) AS n FROM events GROUP BY 1, 2")
def hash_shards(t):
    return t.events.groupBy("user_id", layout.hash_bucket(F.col("user_id"), 4).alias("shard")).agg(F.count("*").alias("n"))


@query("pt_12_range_shards", "PT-12", sql="""
    SELECT CASE WHEN c_custkey < 500 THEN 'shard_1' WHEN c_custkey < 1000 THEN 'shard_2' ELSE 'shard_3' END AS label, count(*) AS row_count FROM customer GROUP BY 1""")
def range_shards(t):
    return layout.partition_counts(t.customer, layout.range_bucket(F.col("c_custkey"), [("shard_1", 500), ("shard_2", 1000)], "shard_3"))


@query("pt_13_directory_shards", "PT-13", sql="""
    SELECT o_orderkey, coalesce('shard_' || d.s, 'shard_default') AS shard FROM orders
    LEFT JOIN (SELECT c_custkey, c_nationkey % 3 AS s FROM customer WHERE c_mktsegment = 'MACHINERY') d ON o_custkey = c_custkey""")
def directory_shards(t):
    directory = t.customer.filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("shard_"), F.col("c_nationkey") % 3).alias("shard"))
    return layout.directory_shard(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", directory, "shard_default").select("o_orderkey", "shard")


@query("pt_14_scatter_gather", "PT-14", sql="""
    SELECT o_orderstatus, count(*) AS cnt, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS mean
    FROM orders GROUP BY 1""")
def scatter_gather(t):
    return layout.scatter_gather(t.orders, ["o_orderstatus"], money("o_totalprice"))


@query("pt_15_shard_skew", "PT-15", sql="""
    SELECT count(*) AS shards, max(n) AS largest, max(n) * count(*) / sum(n)::BIGINT AS skew FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey % 16)""")
def shard_skew(t):
    return layout.shard_skew(t.orders, layout.hash_bucket(F.col("o_custkey"), 16))
