"""Aggregations."""

from pyspark.sql import functions as F

from rowmill.functions.money import money, money_avg, money_sum
from rowmill.operators import aggregates, ordered
from rowmill.plans.registry import query


@query("ag_01_global", "AG-01", sql="""
    SELECT count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, max(o_totalprice) AS largest FROM orders""")
def global_aggregate(t):
    return t.orders.agg(F.count("*").alias("n"), money_sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("largest"))


@query("ag_02_count_forms", "AG-02", sql="""
    SELECT count(*) AS all_rows, count(k) AS non_null, count(1) AS ones FROM (SELECT nullif(c_nationkey, 3) AS k FROM customer)""")
def count_forms(t):
    k = F.nullif(F.col("c_nationkey"), F.lit(3))
    return t.customer.agg(F.count("*").alias("all_rows"), F.count(k).alias("non_null"), F.count(F.lit(1)).alias("ones"))


@query("ag_03_count_distinct", "AG-03", sql="""
    SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT ts::DATE) AS days FROM events GROUP BY event_type""")
def count_distinct(t):
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"),
                                              F.countDistinct(F.to_date("ts")).alias("days"))


@query("ag_04_group_by", "AG-04", sql="""
    SELECT p_brand, count(*) AS n, sum(p_retailprice::DECIMAL(18,2))::DOUBLE / count(*) AS mean_price, min(p_retailprice) AS lowest,
      max(p_retailprice) AS highest, sum(p_retailprice::DECIMAL(18,2) * p_size)::DOUBLE AS stock_value FROM part GROUP BY p_brand""")
def group_by(t):
    return t.part.groupBy("p_brand").agg(
        F.count("*").alias("n"), money_avg("p_retailprice").alias("mean_price"), F.min("p_retailprice").alias("lowest"),
        F.max("p_retailprice").alias("highest"),
        F.sum(money("p_retailprice") * F.col("p_size")).cast("double").alias("stock_value"))


@query("ag_05_having", "AG-05", sql="""
    SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey HAVING count(*) >= 15""")
def having(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("cnt")).filter("cnt >= 15")


@query("ag_06_joined_text", "AG-06", sql="""
    SELECT p_brand, string_agg(p_name, ', ' ORDER BY p_retailprice DESC, p_partkey) AS listing FROM part GROUP BY ALL""")
def joined_text(t):
    return aggregates.joined_text(t.part, ["p_brand"], "p_name", ["-p_retailprice", "p_partkey"])


@query("ag_07_count_pivot", "AG-07", sql="""
    SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'O') AS open,
      count(*) FILTER (o_orderstatus = 'P') AS pending FROM orders GROUP BY o_custkey""")
def count_pivot(t):
    s = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(F.count_if(s == "F").alias("finished"), F.count_if(s == "O").alias("open"),
                                             F.count_if(s == "P").alias("pending"))


@query("ag_08_value_pivot", "AG-08", sql="""
    SELECT year(o_orderdate) AS yr, coalesce(sum(p) FILTER (q = 1), 0)::DOUBLE AS q1, coalesce(sum(p) FILTER (q = 2), 0)::DOUBLE AS q2,
      coalesce(sum(p) FILTER (q = 3), 0)::DOUBLE AS q3, coalesce(sum(p) FILTER (q = 4), 0)::DOUBLE AS q4, sum(p)::DOUBLE AS total
    FROM (SELECT o_orderdate, quarter(o_orderdate) AS q, o_totalprice::DECIMAL(18,2) AS p FROM orders) GROUP BY 1""")
def value_pivot(t):
    df = t.orders.select(F.year("o_orderdate").cast("bigint").alias("yr"), F.concat(F.lit("q"), F.quarter("o_orderdate")).alias("q"),
                         "o_totalprice")
    out = aggregates.pivot_sums(df, ["yr"], "q", ["q1", "q2", "q3", "q4"], money("o_totalprice"))
    return out.select("yr", *[F.col(c).cast("double").alias(c) for c in out.columns[1:]])


@query("ag_09_step_flags", "AG-09", sql="""
    SELECT user_id, ts::DATE AS day, max((event_type = 'view')::INT) AS viewed, max((event_type = 'click')::INT) AS clicked,
      max((event_type = 'purchase')::INT) AS bought FROM events GROUP BY 1, 2""")
def step_flags(t):
    flag = lambda v: F.max(F.when(F.col("event_type") == v, 1).otherwise(0))
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        flag("view").alias("viewed"), flag("click").alias("clicked"), flag("purchase").alias("bought"))


@query("ag_10_boolean_ratio", "AG-10", sql="""
    SELECT o_orderpriority, sum((o_orderstatus <> 'F')::INT)::DOUBLE / count(*) AS unfinished FROM orders GROUP BY 1""")
def boolean_ratio(t):
    return t.orders.groupBy("o_orderpriority").agg((F.count_if(F.col("o_orderstatus") != "F") / F.count("*")).alias("unfinished"))


@query("ag_11_safe_ratio", "AG-11", sql="""
    SELECT user_id, count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'signup' AND value > 10), 0)
      AS per_signup FROM events GROUP BY user_id""")
def safe_ratio(t):
    e = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        F.try_divide(F.count_if(e == "purchase"), F.count_if((e == "signup") & (F.col("value") > 10))).alias("per_signup"))


@query("ag_12_arg_max_group", "AG-12", sql="""
    SELECT c_nationkey, sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM customer GROUP BY 1
    ORDER BY mean DESC, c_nationkey LIMIT 1""")
def arg_max_group(t):
    return (t.customer.groupBy("c_nationkey").agg(money_avg("c_acctbal").alias("mean"))
            .orderBy(F.desc("mean"), "c_nationkey").limit(1))


@query("ag_13_bought_by_all", "AG-13", sql="""
    SELECT p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING count(DISTINCT c_nationkey) = (SELECT count(*) FROM nation)""")
def bought_by_all(t):
    buyers = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    sold = (t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
            .join(buyers.select("o_orderkey", "c_nationkey"), "o_orderkey")
            .join(t.part.select("p_partkey", "p_name", "p_brand"), "p_partkey"))
    return aggregates.bought_by_all(sold, ["p_name", "p_brand"], "c_nationkey", t.nation)


@query("ag_14_aggregate_of_aggregate", "AG-14", sql="""
    SELECT max(n) AS most, min(n) AS fewest FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def aggregate_of_aggregate(t):
    return t.lineitem.groupBy("l_orderkey").count().agg(F.max("count").alias("most"), F.min("count").alias("fewest"))


@query("ag_15_share_of_total", "AG-15", sql="""
    SELECT o_orderpriority, count(*) AS cnt, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 2) AS pct FROM orders GROUP BY 1""")
def share_of_total(t):
    return aggregates.share_of_total(t.orders, ["o_orderpriority"])


@query("ag_16_group_median", "AG-16", sql="""
    SELECT c_nationkey, median(c_acctbal) AS median FROM customer GROUP BY 1""")
def group_median(t):
    return ordered.medians(t.customer, ["c_nationkey"], "c_acctbal")


@query("ag_17_global_median", "AG-17", sql="SELECT median(o_totalprice) AS median FROM orders")
def global_median(t):
    return ordered.medians(t.orders, [], "o_totalprice")


@query("ag_18_null_profile", "AG-18", sql="""
    WITH d AS (SELECT nullif(c_nationkey, 3) AS nation, nullif(c_mktsegment, 'MACHINERY') AS segment, c_custkey AS id FROM customer)
    SELECT 'nation' AS column_name, count(*) FILTER (nation IS NULL) AS nulls, count(*) AS row_count FROM d
    UNION ALL SELECT 'segment', count(*) FILTER (segment IS NULL), count(*) FROM d
    UNION ALL SELECT 'id', count(*) FILTER (id IS NULL), count(*) FROM d""")
def null_profile(t):
    return aggregates.null_profile(t.customer.select(
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"), F.col("c_custkey").alias("id")))


@query("ag_19_duplicates", "AG-19", sql="""
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicates(t):
    return aggregates.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("ag_20_prefix_selectivity", "AG-20", sql="""
    SELECT count(DISTINCT left(c_name, 5)) / count(*) AS sel_5, count(DISTINCT left(c_name, 10)) / count(*) AS sel_10,
      count(DISTINCT left(c_name, 17)) / count(*) AS sel_17, count(DISTINCT c_name) / count(*) AS sel_full FROM customer""")
def prefix_selectivity(t):
    return aggregates.prefix_selectivity(t.customer, "c_name", [5, 10, 17])


@query("ag_21_cardinality", "AG-21", sql="""
    SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS cardinality, count(DISTINCT o_custkey) / count(*) AS selectivity FROM orders
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), count(DISTINCT o_orderstatus) / count(*) FROM orders
    UNION ALL SELECT 'o_orderkey', count(DISTINCT o_orderkey), count(DISTINCT o_orderkey) / count(*) FROM orders""")
def cardinality(t):
    return aggregates.cardinality(t.orders, ["o_custkey", "o_orderstatus", "o_orderkey"])


@query("ag_21_cardinality_sketch", "AG-21", sql="""
    SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS cardinality, true AS close FROM orders
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), true FROM orders
    UNION ALL SELECT 'o_orderkey', count(DISTINCT o_orderkey), true FROM orders""")
def cardinality_sketch(t):
    """The sketch beside the exact count: within four times its relative deviation of 5 %."""
    columns = ["o_custkey", "o_orderstatus", "o_orderkey"]
    rough = aggregates.cardinality(t.orders, columns, approximate=True).select("column_name", F.col("cardinality").alias("rough"))
    both = aggregates.cardinality(t.orders, columns).join(rough, "column_name")
    return both.select("column_name", "cardinality", (F.abs(F.col("rough") / F.col("cardinality") - 1) <= 0.2).alias("close"))


@query("ag_22_singleton_histogram", "AG-22", sql="""
    SELECT p_size, cnt, sum(cnt) OVER (ORDER BY p_size)::BIGINT / sum(cnt) OVER ()::BIGINT AS cumulative
    FROM (SELECT p_size, count(*) AS cnt FROM part GROUP BY 1)""")
def singleton_histogram(t):
    return aggregates.histogram(t.part, "p_size", 50)


@query("ag_22_height_histogram", "AG-22", sql="""
    WITH v AS (SELECT o_totalprice AS x, count(*) AS n FROM orders GROUP BY 1),
      c AS (SELECT x, n, sum(n) OVER (ORDER BY x)::BIGINT AS upto, sum(n) OVER ()::BIGINT AS total FROM v)
    SELECT (upto - 1) * 50 // total + 1 AS bucket, min(x) AS low, max(x) AS high, sum(n)::BIGINT AS cnt, count(*) AS "values" FROM c GROUP BY 1""")
def height_histogram(t):
    return aggregates.histogram(t.orders, "o_totalprice", 50)


@query("ag_23_first_last_span", "AG-23", sql="""
    SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order, count(*) AS orders,
      date_diff('day', min(o_orderdate), max(o_orderdate)) AS days FROM orders GROUP BY 1""")
def first_last_span(t):
    d = "o_orderdate"
    return t.orders.groupBy("o_custkey").agg(F.min(d).alias("first_order"), F.max(d).alias("last_order"), F.count("*").alias("orders"),
                                             F.datediff(F.max(d), F.min(d)).cast("bigint").alias("days"))


@query("ag_24_table_counts", "AG-24", sql="""
    SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events""")
def table_counts(t):
    out = None
    for name in ("customer", "orders", "lineitem", "events"):
        one = getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("ag_25_group_distribution", "AG-25", sql="""
    SELECT o_orderstatus, count(*) AS cnt, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM orders GROUP BY 1 ORDER BY cnt DESC""")
def group_distribution(t):
    return (t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("cnt"), money_avg("o_totalprice").alias("mean"))
            .orderBy(F.desc("cnt"), "o_orderstatus"))


@query("ag_26_row_count", "AG-26", sql="SELECT count(*) AS n FROM lineitem")
def row_count(t):
    return t.lineitem.agg(F.count("*").alias("n"))  # answered from Parquet footers, no column is read


@query("ag_26_rough_count", "AG-26", sql="SELECT count(*) AS row_count, true AS close FROM lineitem")
def rough_count(t):
    """The estimate from the footers of up to 100 files beside the exact count: within its margin."""
    rough, margin = aggregates.rough_count(t.lineitem)
    exact = t.lineitem.agg(F.count("*").alias("row_count"))
    return exact.select("row_count", (F.abs(F.col("row_count") - rough) <= margin).alias("close"))
