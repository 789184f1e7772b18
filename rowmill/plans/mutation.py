"""Table changes, bound to the input tables."""

import os
import uuid

from pyspark.sql import functions as F

from rowmill.functions.money import money
from rowmill.functions.scalar import start_of
from rowmill.operators import mutate
from rowmill.plans.registry import query
from rowmill.session import materialize, shared_folder
from rowmill.sources.scan import latest
from rowmill.sources.versioned import VersionedTable

ORD = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def orders(t):
    return t.orders.select(*ORD)


@query("src_08_append", "SRC-08", sql="""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey + 1000000, 'P', o_totalprice / 2 FROM orders WHERE o_orderkey % 10 = 0""")
def append(t):
    rows = orders(t).filter("o_orderkey % 10 = 0").select((F.col("o_orderkey") + 1000000).alias("o_orderkey"),
                                                         F.lit("P").alias("o_orderstatus"), (F.col("o_totalprice") / 2).alias("o_totalprice"))
    return mutate.append(orders(t), rows)


@query("src_09_insert_select", "SRC-09", sql="""
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
    UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'""")
def insert_select(t):
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    archive = t.orders.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderdate")
    return mutate.append(archive, t.orders.filter((F.col("o_orderdate") >= cut) & (F.col("o_orderstatus") == "F"))
                         .select("o_orderkey", "o_orderdate"))


BATCH = """t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey // 2 AS o_orderkey, o_orderkey AS seq,
    'B' || o_orderstatus AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders)"""


def target_and_batch(t):
    """A target without every third order, and a batch whose keys repeat twice."""
    target = orders(t).filter("o_orderkey % 3 <> 0")
    batch = orders(t).select(F.floor(F.col("o_orderkey") / 2).alias("o_orderkey"), F.col("o_orderkey").alias("seq"),
                             F.concat(F.lit("B"), "o_orderstatus").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return target, batch


@query("src_10_insert_ignore", "SRC-10", sql=f"""
    WITH {BATCH} SELECT o_orderkey, o_orderstatus, o_totalprice FROM t UNION ALL
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq) AS rn FROM b) x
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = x.o_orderkey)""")
def insert_ignore(t):
    target, batch = target_and_batch(t)
    target = target.withColumn("seq", F.lit(None).cast("bigint"))
    return mutate.insert_ignore(target, batch, ["o_orderkey"], ["seq"]).drop("seq")


@query("src_11_upsert", "SRC-11", sql=f"""
    WITH {BATCH}, l AS (SELECT o_orderkey, first(o_orderstatus ORDER BY seq) AS s, last(o_totalprice ORDER BY seq) AS p FROM b GROUP BY 1)
    SELECT coalesce(t.o_orderkey, l.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN l.s ELSE t.o_orderstatus END AS o_orderstatus,
      coalesce(l.p, t.o_totalprice) AS o_totalprice FROM t FULL JOIN l ON t.o_orderkey = l.o_orderkey""")
def upsert(t):
    target, batch = target_and_batch(t)
    return mutate.upsert(target, batch, ["o_orderkey"], ["o_totalprice"], order=["seq"])


SLICES = 64
STORED = f"""m AS (SELECT max(o_orderkey) + 1 AS n FROM orders), t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 50 <> 7),
    b AS (SELECT o_orderkey, 'B' || o_orderstatus AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders, m WHERE o_orderkey * 100 >= n * 99)"""


def stored_orders(t):
    """Orders without some, in a stored table of SLICES ranges of the key, and a batch with the newest hundredth of all."""
    n = t.orders.agg(F.max("o_orderkey") + 1).scalar()
    part = F.floor(F.col("o_orderkey") * SLICES / n).cast("int")
    rows = orders(t).withColumn("part", part)
    batch = rows.filter(F.col("o_orderkey") * 100 >= n * 99).withColumns(
        {"o_orderstatus": F.concat(F.lit("B"), "o_orderstatus"), "o_totalprice": F.col("o_totalprice") + 1})
    table = VersionedTable(t.spark, os.path.join(shared_folder(t.spark), f"orders-by-key-{uuid.uuid4().hex}"), "part")
    table.create(rows.filter("o_orderkey % 50 <> 7"))
    return table, batch


def stored_files(table):
    """(part, the names of its files)."""
    return table.read().groupBy("part").agg(F.array_sort(F.collect_set("_metadata.file_path")).alias("files"))


@query("src_11_upsert_stored", "SRC-11", sql=f"""
    WITH {STORED}, u AS (SELECT coalesce(t.o_orderkey, b.o_orderkey) AS k, CASE WHEN t.o_orderkey IS NULL THEN b.o_orderstatus ELSE t.o_orderstatus END AS s,
      coalesce(b.o_totalprice, t.o_totalprice) AS p, b.o_orderkey IS NOT NULL AS hit FROM t FULL JOIN b ON t.o_orderkey = b.o_orderkey)
    SELECT floor(k * {SLICES} / n)::INTEGER AS part, count(*) AS row_count, sum(p::DECIMAL(18,2))::DOUBLE AS total, count_if(s LIKE 'B%')::BIGINT AS inserted,
      bool_or(hit) AS rewritten FROM u, m GROUP BY 1""")
def upsert_stored(t):
    """Upsert into a stored table: ranges without a key of the batch keep their files."""
    table, batch = stored_orders(t)
    before = materialize(stored_files(table))
    table.upsert(batch, ["o_orderkey"], ["o_totalprice"])
    counts = table.read().groupBy("part").agg(F.count("*").alias("row_count"), F.sum(money("o_totalprice")).cast("double").alias("total"),
                                              F.count_if(F.col("o_orderstatus").startswith("B")).alias("inserted"))
    old = before.withColumnRenamed("files", "old")
    return (counts.join(stored_files(table), "part").join(old, "part", "left")
            .select("part", "row_count", "total", "inserted", (~F.col("files").eqNullSafe(F.col("old"))).alias("rewritten")))


@query("src_12_upsert_add", "SRC-12", sql="""
    SELECT user_id, minute, sum(n)::BIGINT AS n FROM (SELECT user_id, date_trunc('hour', ts) AS minute, count(*) AS n FROM events
      WHERE event_id % 2 = 0 GROUP BY 1, 2 UNION ALL SELECT user_id, date_trunc('hour', ts), 1 FROM events WHERE event_id % 2 = 1) GROUP BY 1, 2""")
def upsert_add(t):
    e = t.events.withColumn("minute", start_of("HOUR", F.col("ts")))
    counts = e.filter("event_id % 2 = 0").groupBy("user_id", "minute").agg(F.count("*").alias("n"))
    return mutate.upsert_add(counts, e.filter("event_id % 2 = 1").withColumn("n", F.lit(1).cast("bigint")), ["user_id", "minute"], "n")


@query("src_13_update", "SRC-13", sql="""
    SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN (p_retailprice::DECIMAL(18,2) * 0.9)::DOUBLE ELSE p_retailprice END AS p_retailprice FROM part""")
def update(t):
    cheaper = (money("p_retailprice") * F.lit("0.9").cast("decimal(2,1)")).cast("double")
    return mutate.update(t.part.select("p_partkey", "p_type", "p_retailprice"), {"p_retailprice": cheaper}, F.col("p_type") == "SMALL").drop("p_type")


@query("src_14_update_in_subquery", "SRC-14", sql="""
    SELECT p_partkey, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 35) THEN p_size + 100 ELSE p_size END AS p_size FROM part""")
def update_in_subquery(t):
    busy = t.lineitem.groupBy("l_partkey").count().filter("count > 35").select("l_partkey")
    return mutate.update_in(t.part.select("p_partkey", "p_size"), {"p_size": F.col("p_size") + 100}, "p_partkey", busy)


@query("src_15_update_join", "SRC-15", sql="""
    SELECT s_suppkey, CASE WHEN n_regionkey = 2 THEN s_acctbal + 100 ELSE s_acctbal END AS s_acctbal FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey""")
def update_join(t):
    regions = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    out = mutate.update_joined(t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"), regions, ["s_nationkey"],
                               {"s_acctbal": F.col("s_acctbal") + 100}, F.col("n_regionkey") == 2)
    return out.select("s_suppkey", "s_acctbal")


@query("src_16_delete", "SRC-16", sql="""
    SELECT c_custkey FROM (SELECT *, nullif(c_nationkey, 3) AS k FROM customer) WHERE NOT coalesce(k < 10 AND c_acctbal < 5000, false)""")
def delete(t):
    d = t.customer.withColumn("k", F.nullif(F.col("c_nationkey"), F.lit(3)))
    return mutate.delete(d, (F.col("k") < 10) & (F.col("c_acctbal") < 5000)).select("c_custkey")


@query("src_17_delete_first", "SRC-17", sql="""
    SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'
      ORDER BY o_orderdate, o_orderkey LIMIT 100)""")
def delete_first(t):
    d = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return mutate.delete_first(d, F.col("o_orderstatus") == "P", ["o_orderdate", "o_orderkey"], 100, "o_orderkey").select("o_orderkey")


@query("src_18_keep_lowest", "SRC-18", sql="""
    WITH d AS (SELECT p_partkey, CASE WHEN p_size > 3 THEN p_name END AS email FROM part)
    SELECT p_partkey FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE a.email = b.email AND a.p_partkey > b.p_partkey)""")
def keep_lowest(t):
    d = t.part.select("p_partkey", F.when(F.col("p_size") > 3, F.col("p_name")).alias("email"))
    return mutate.keep_lowest(d, "email", "p_partkey").select("p_partkey")


@query("src_20_update_view", "SRC-20", sql="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 300000 THEN 'high' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def update_view(t):
    d = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    out = mutate.update_view(d, F.col("o_orderstatus") == "O", {"o_orderpriority": F.lit("high")}, F.col("o_totalprice") > 300000)
    return out.select("o_orderkey", "o_orderpriority")


@query("src_22_assign_ids", "SRC-22", sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n, sum(id)::BIGINT AS ids FROM (SELECT *, 1 + (row_number() OVER (ORDER BY l_orderkey,
      l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1) * 2 AS id
      FROM lineitem) GROUP BY ALL""")
def assign_ids(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_shipdate", "l_returnflag", "l_linestatus"]
    return (mutate.assign_ids(t.lineitem, order, start=1, step=2).groupBy("l_orderkey", "l_linenumber", "l_partkey")
            .agg(F.count("*").alias("n"), F.sum("id").alias("ids")))


@query("src_23_touch", "SRC-23", sql="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN (SELECT max(o_orderdate) FROM orders) ELSE o_orderdate END AS updated_at FROM orders""")
def touch(t):
    d = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("updated_at"))
    return mutate.touch(d, F.col("o_orderstatus") == "P", latest(t.orders, "o_orderdate")).drop("o_orderstatus")


@query("src_21_defaults", "SRC-21", "DQ-08", sql="""
    SELECT s_suppkey AS id, s_name AS name, 0 AS clicks, s_acctbal::DECIMAL(12,2)::DOUBLE AS balance, 'pending' AS status FROM supplier""")
def defaults(t):
    given = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    out = mutate.with_defaults(given, "id bigint, name string, clicks int, balance decimal(12,2), status string",
                               {"clicks": F.lit(0), "status": F.lit("pending")})
    return out.withColumn("balance", F.col("balance").cast("double"))


@query("src_24_schema_change", "SRC-24", sql="""
    SELECT s_suppkey, 'unknown' AS phone, s_name, s_acctbal::DECIMAL(18,4)::DOUBLE AS s_acctbal FROM supplier""")
def schema_change(t):
    d = mutate.add_column(t.supplier, "phone", "string", after="s_suppkey")
    d = mutate.backfill(mutate.widen_column(d, "s_acctbal", "decimal(18,4)"), "phone", F.lit("unknown")).drop("s_nationkey")
    return d.withColumn("s_acctbal", F.col("s_acctbal").cast("double"))
