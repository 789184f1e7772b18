"""Projections, filters and predicates, set operations."""

from pyspark.sql import functions as F

from rowmill.functions.money import money
from rowmill.operators import filters
from rowmill.plans.registry import query
from rowmill.sources.scan import latest, literal_rows, series


@query("src_01_scan_columns", "SRC-01", sql="SELECT o_orderkey, o_totalprice FROM orders")
def scan_columns(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("src_02_literal_rows", "SRC-02", sql="""
    SELECT w.label, count(*) AS orders FROM orders o
    JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) w(code, label) ON o.o_orderstatus = w.code
    GROUP BY w.label""")
def literal_relation(t):
    words = literal_rows(t.spark, "code string, label string", [("F", "finished"), ("O", "open"), ("P", "pending")])
    return (t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
            .join(F.broadcast(words), F.col("o_orderstatus") == F.col("code")).select("label", "orders"))


@query("src_03_integer_series", "SRC-03", sql="""
    SELECT n, n * 10 AS tens, n IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS finished
    FROM range(1, 1 + (SELECT count(*) FROM orders)) s(n)""")
def integer_series(t):
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("n"))
    numbers = series(t.spark, 1, t.orders.count())
    return (numbers.join(finished.distinct().withColumn("hit", F.lit(True)), "n", "left")
            .select("n", (F.col("n") * 10).alias("tens"), F.coalesce("hit", F.lit(False)).alias("finished")))


@query("pf_01_projection", "PF-01", sql="""
    SELECT p_partkey, p_name AS product, (p_retailprice::DECIMAL(18,2) * 1.1)::DOUBLE AS price_with_tax FROM part""")
def projection(t):
    return t.part.select("p_partkey", F.col("p_name").alias("product"),
                         (money("p_retailprice") * F.lit("1.1").cast("decimal(2,1)")).cast("double")
                         .alias("price_with_tax"))


@query("pf_02_conjunction", "PF-02", sql="""
    SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' AND p_retailprice < 1000""")
def conjunction(t):
    return t.part.filter((F.col("p_type") == "ECONOMY") & (F.col("p_retailprice") < 1000)).select("p_partkey", "p_name")


@query("pf_03_between", "PF-03", sql="""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'
      AND o_totalprice BETWEEN 1000 AND 200000""")
def between(t):
    return t.orders.filter(
        F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-03-31").cast("timestamp_ntz"))
        & F.col("o_totalprice").between(1000, 200000)).select("o_orderkey", "o_orderdate")


@query("pf_04_in_list", "PF-04", sql="""
    SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def in_list(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("pf_05_not_in_list", "PF-05", sql="""
    SELECT o_orderkey FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status NOT IN ('F', 'X')""")
def not_in_list(t):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.withColumn("status", status).filter(~F.col("status").isin("F", "X")).select("o_orderkey")


@query("pf_06_like", "PF-06", sql="""
    SELECT p_partkey, p_name LIKE 'red%' AS starts, p_name LIKE '%ring' AS ends, p_name LIKE '%e w%' AS inside,
           p_name LIKE '_ed%' AS one_char
    FROM part WHERE p_name LIKE 'r%' OR p_name LIKE '%t' OR p_brand LIKE 'Brand#_'""")
def like(t):
    n = F.col("p_name")
    return (t.part.filter(n.like("r%") | n.like("%t") | F.col("p_brand").like("Brand#_"))
            .select("p_partkey", n.like("red%").alias("starts"), n.like("%ring").alias("ends"),
                    n.like("%e w%").alias("inside"), n.like("_ed%").alias("one_char")))


@query("pf_07_null_tests", "PF-07", sql="""
    SELECT c_custkey, nationkey IS NULL AS missing FROM
      (SELECT c_custkey, c_acctbal, nullif(c_nationkey, 3) AS nationkey FROM customer)
    WHERE nationkey IS NULL OR (nationkey IS NOT NULL AND c_acctbal < 0)""")
def null_tests(t):
    df = t.customer.withColumn("nationkey", F.nullif(F.col("c_nationkey"), F.lit(3)))
    k = F.col("nationkey")
    return df.filter(k.isNull() | (k.isNotNull() & (F.col("c_acctbal") < 0))).select("c_custkey", k.isNull().alias("missing"))


@query("pf_08_comparisons", "PF-08", sql="""
    SELECT p_partkey FROM part
    WHERE p_size <> 10 AND p_size >= 5 AND p_size <= 40 AND p_retailprice > 905 AND p_retailprice < 1900
      AND p_brand != 'Brand#1' AND NOT p_type = 'SMALL'""")
def comparisons(t):
    size, price = F.col("p_size"), F.col("p_retailprice")
    return t.part.filter((size != 10) & (size >= 5) & (size <= 40) & (price > 905) & (price < 1900)
                         & (F.col("p_brand") != "Brand#1") & ~(F.col("p_type") == "SMALL")).select("p_partkey")


OR_SQL = """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderstatus = 'P' OR o_totalprice > 400000"""


@query("pf_09_disjunction", "PF-09", sql=OR_SQL)
def disjunction(t):
    return (t.orders.filter((F.col("o_orderstatus") == "P") | (F.col("o_totalprice") > 400000))
            .select("o_orderkey", "o_orderstatus", "o_totalprice"))


@query("so_03_disjoint_union", "SO-03", sql=OR_SQL)
def or_as_union(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return filters.disjoint_union(df, F.col("o_orderstatus") == "P", F.col("o_totalprice") > 400000)


@query("pf_10_filter_on_alias", "PF-10", sql="""
    SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        (l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS net FROM lineitem)
    WHERE net > 80000""")
def filter_on_alias(t):
    net = (money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("double")
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", net.alias("net"))
            .filter(F.col("net") > 80000))


@query("pf_11_null_safe_equal", "PF-11", sql="""
    SELECT c_custkey, a IS NOT DISTINCT FROM b AS safe, a = b AS plain, a = a AS self
    FROM (SELECT c_custkey, nullif(c_nationkey, 1) AS a, nullif(c_nationkey % 5, 1) AS b FROM customer)""")
def null_safe_equal(t):
    a, b = F.col("a"), F.col("b")
    return (t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(1)).alias("a"),
                              F.nullif(F.col("c_nationkey") % 5, F.lit(1)).alias("b"))
            .select("c_custkey", a.eqNullSafe(b).alias("safe"), (a == b).alias("plain"), (a == a).alias("self")))


@query("pf_12_searched_case", "PF-12", sql="""
    SELECT p_partkey, CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1500 THEN 'mid' ELSE 'high' END AS band
    FROM part""")
def searched_case(t):
    p = F.col("p_retailprice")
    return t.part.select("p_partkey", F.when(p < 950, "low").when(p < 1500, "mid").otherwise("high").alias("band"))


@query("pf_13_simple_case", "PF-13", sql="""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status
    FROM orders""")
def simple_case(t):
    s = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", F.when(s == "F", "finished").when(s == "O", "open").otherwise("other").alias("status"))


@query("pf_14_distinct", "PF-14", sql="SELECT DISTINCT p_brand, p_type FROM part")
def distinct(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("pf_15_year_range", "PF-15", sql="""
    SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997""")
def year_filter(t):
    return t.orders.filter(filters.year_range("o_orderdate", 1997)).select("o_orderkey", "o_totalprice")


@query("pf_16_relative_time", "PF-16", sql="""
    SELECT event_id, ts FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY AND ts < (SELECT max(ts) FROM events) - INTERVAL 5 HOUR""")
def relative_time(t):
    e = t.events
    return e.filter((F.col("ts") >= latest(e, "ts", "7 DAYS")) & (F.col("ts") < latest(e, "ts", "5 HOURS"))).select("event_id", "ts")


@query("pf_17_collation", "PF-17", sql="""
    SELECT lower(strip_accents(label)) AS label, count(*) AS n, count(*) FILTER (lower(label) LIKE '%ing%') AS with_ing FROM
      (SELECT CASE WHEN p_size % 3 = 0 THEN upper(p_name) WHEN p_size % 3 = 1 THEN replace(p_name, 'e', 'é') ELSE p_name END
              AS label FROM part)
    WHERE lower(strip_accents(label)) <> 'red widget' GROUP BY 1""")
def collation(t):
    n = F.col("p_name")
    df = t.part.select(F.when(F.col("p_size") % 3 == 0, F.upper(n)).when(F.col("p_size") % 3 == 1, F.replace(n, F.lit("e"), F.lit("é")))
                       .otherwise(n).alias("label"))
    df = df.filter(~filters.same_text(F.col("label"), F.lit("RED Widget")))
    out = df.groupBy(filters.folded(F.col("label")).alias("k")).agg(
        F.min(F.lower(F.translate(F.collate(F.col("label"), "UTF8_BINARY"), "éÉ", "eE"))).alias("label"), F.count("*").alias("n"),
        F.count_if(filters.like_ci(F.col("label"), "%ING%")).alias("with_ing"))
    return out.select("label", "n", "with_ing")


@query("pf_18_soft_delete", "PF-18", sql="""
    SELECT is_active, count(*) AS n, min(o_orderkey) AS first_key FROM
      (SELECT o_orderkey, (CASE WHEN o_orderstatus = 'P' THEN o_orderdate END) IS NULL AS is_active FROM orders)
    GROUP BY is_active""")
def soft_delete(t):
    df = t.orders.withColumn("deleted_at", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")))
    return (filters.with_active_flag(df).groupBy("is_active")
            .agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")))


@query("pf_18_active_view", "PF-18", sql="SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'")
def active_view(t):
    df = t.orders.withColumn("deleted_at", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")))
    return filters.active(df).select("o_orderkey")


@query("pf_19_tenant_scope", "PF-19", sql="""
    SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 7 AND c_acctbal > 0""")
def tenant_scope(t):
    return filters.scoped(t.customer, "c_nationkey", 7).filter("c_acctbal > 0").select("c_custkey", "c_name")


@query("pf_20_boolean_flag", "PF-20", sql="""
    SELECT c_nationkey, count(*) >= 60 AS at_limit, sum((c_acctbal < 0)::INT)::BIGINT AS overdrawn
    FROM customer GROUP BY c_nationkey""")
def boolean_flag(t):
    return t.customer.groupBy("c_nationkey").agg((F.count("*") >= 60).alias("at_limit"),
                                                 F.sum((F.col("c_acctbal") < 0).cast("int")).alias("overdrawn"))


@query("pf_21_expressions", "PF-21", sql="""
    SELECT p_partkey, (p_size * 0.1 + 0.2)::DOUBLE AS tenths, (CAST(0.1 AS DECIMAL(5,2)) + CAST(0.2 AS DECIMAL(5,2)))::DOUBLE AS exact
    FROM part""")
def expressions(t):
    return t.part.selectExpr("p_partkey", "CAST(p_size * 0.1 + 0.2 AS DOUBLE) AS tenths",
                             "CAST(CAST(0.1 AS DECIMAL(5,2)) + CAST(0.2 AS DECIMAL(5,2)) AS DOUBLE) AS exact")


@query("so_01_union", "SO-01", sql="SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return (t.customer.select(F.col("c_nationkey").alias("nationkey"))
            .unionByName(t.supplier.select(F.col("s_nationkey").alias("nationkey"))).distinct())


@query("so_02_union_all", "SO-02", sql="""
    SELECT 'customer' AS side, c_nationkey AS nationkey, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def union_all(t):
    a = t.customer.select(F.lit("customer").alias("side"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.lit("supplier").alias("side"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b)
