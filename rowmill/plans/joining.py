"""Join forms and subquery forms."""

from pyspark.sql import functions as F

from rowmill.functions.money import money, money_avg
from rowmill.operators import ordered
from rowmill.operators.joins import bounded_broadcast, full_join, grid, not_in, skew_join
from rowmill.plans.bindings import DEPT, EMP, dept, emp
from rowmill.plans.registry import query


@query("jn_01_inner", "JN-01", sql="""
    SELECT c_custkey, n_name FROM (SELECT c_custkey, nullif(c_nationkey, 4) AS k FROM customer) JOIN nation ON k = n_nationkey""")
def inner(t):
    c = t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(4)).alias("n_nationkey"))
    return c.join(t.nation, "n_nationkey").select("c_custkey", "n_name")


@query("jn_02_left_default", "JN-02", sql="""
    SELECT o_orderkey, coalesce(l_returnflag, 'none') AS flag, coalesce(n, 0) AS lines FROM orders
    LEFT JOIN (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) ON o_orderkey = l_orderkey""")
def left_default(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").agg(F.count("*").alias("n"))
    return (t.orders.select("o_orderkey").join(lines, "o_orderkey", "left")
            .select("o_orderkey", F.coalesce("l_returnflag", F.lit("none")).alias("flag"), F.coalesce("n", F.lit(0)).alias("lines")))


@query("jn_03_right_count", "JN-03", sql="""
    SELECT o_orderkey, count(l_partkey) AS lines FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def right_count(t):
    # Counting lines per order first keeps the join one row per order.
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_partkey").alias("n"))
    return (lines.join(t.orders.select("o_orderkey"), "o_orderkey", "right")
            .groupBy("o_orderkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines")))


@query("jn_04_full_union", "JN-04", sql=f"""
    WITH {EMP}, {DEPT}
    SELECT e.name, d.dept FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id AND d.location <> 2
    UNION SELECT e.name, d.dept FROM emp e RIGHT JOIN (SELECT * FROM dept WHERE location <> 2) d ON e.dept_id = d.dept_id""")
def full_union(t):
    d = dept(t).filter("location <> 2")
    return full_join(emp(t), d, ["dept_id"]).select("name", "dept").distinct()


@query("jn_05_self_left", "JN-05", sql=f"""
    WITH {EMP} SELECT e.emp_id, e.name, m.name AS manager FROM emp e LEFT JOIN emp m ON e.manager_id = m.emp_id""")
def self_left(t):
    e = emp(t)
    m = e.select(F.col("emp_id").alias("manager_id"), F.col("name").alias("manager"))
    return e.join(m, "manager_id", "left").select("emp_id", "name", "manager")


@query("jn_06_self_compare", "JN-06", sql=f"""
    WITH {EMP} SELECT e.emp_id, e.salary, m.salary AS manager_salary FROM emp e
    JOIN emp m ON e.manager_id = m.emp_id AND e.salary > m.salary""")
def self_compare(t):
    e = emp(t)
    m = e.select(F.col("emp_id").alias("manager_id"), F.col("salary").alias("manager_salary"))
    return e.join(m, "manager_id").filter("salary > manager_salary").select("emp_id", "salary", "manager_salary")


@query("jn_07_cross", "JN-07", sql="""
    SELECT r_name, c_mktsegment FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer)""")
def cross(t):
    return grid(t.region.select("r_name"), t.customer.select("c_mktsegment").distinct())


WIDE = """SELECT o_orderkey, o_orderdate, c_name, n_name, p_name, p_retailprice, l_quantity, l_extendedprice FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""


def wide_orders(t):
    c = t.customer.join(bounded_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
            .join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c.select("c_custkey", "c_name", "n_name"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t.part.select("p_partkey", "p_name", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
            .select("o_orderkey", "o_orderdate", "c_name", "n_name", "p_name", "p_retailprice", "l_quantity", "l_extendedprice"))


@query("jn_08_multiway", "JN-08", sql=WIDE)
def multiway(t):
    return wide_orders(t)


@query("jn_09_left_on_predicate", "JN-09", sql=f"""
    WITH {EMP}, {DEPT} SELECT e.emp_id, d.dept FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id AND d.location = 1""")
def left_on_predicate(t):
    return emp(t).join(dept(t).filter("location = 1"), "dept_id", "left").select("emp_id", "dept")


@query("jn_10_left_where_predicate", "JN-10", sql=f"""
    WITH {EMP}, {DEPT} SELECT e.emp_id, d.dept FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id WHERE d.location = 1""")
def left_where_predicate(t):
    return emp(t).join(dept(t), "dept_id", "left").filter("location = 1").select("emp_id", "dept")


NO_LINES = """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""


@query("jn_11_anti_left_null", "JN-11", sql=f"""
    WITH {EMP}, {DEPT} SELECT e.emp_id FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id WHERE d.dept_id IS NULL""")
def anti_left_null(t):
    return emp(t).join(dept(t), "dept_id", "left_anti").select("emp_id")


@query("jn_12_not_exists", "JN-12", sql="""
    SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def not_exists(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left_anti")


@query("jn_13_not_in", "JN-13", sql=NO_LINES)
def not_in_clean(t):
    return not_in(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", t.lineitem, "l_orderkey")


@query("jn_13_not_in_null_trap", "JN-13", sql="""
    SELECT count(*) AS kept FROM orders WHERE o_orderkey NOT IN (SELECT nullif(l_orderkey, 1) FROM lineitem)""")
def not_in_null(t):
    listed = t.lineitem.select(F.nullif(F.col("l_orderkey"), F.lit(1)).alias("k"))
    return not_in(t.orders.select("o_orderkey"), "o_orderkey", listed, "k").agg(F.count("*").alias("kept"))


SEMI = """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)"""


@query("jn_14_semi_in", "JN-14", sql=SEMI)
def semi_in(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("jn_15_semi_exists", "JN-15", sql="""
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def semi_exists(t):
    return semi_in(t)


MAX_PER_GROUP = """SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    WHERE (c_mktsegment, c_acctbal) IN (SELECT c_mktsegment, max(c_acctbal) FROM customer GROUP BY c_mktsegment)"""


@query("jn_16_tuple_in", "JN-16", "AP-39", sql=MAX_PER_GROUP)
def tuple_in(t):
    best = t.customer.groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("c_acctbal"))
    return (t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
            .join(best, ["c_mktsegment", "c_acctbal"], "left_semi"))


@query("sq_11_group_maximum", "SQ-11", sql="""
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer c
    WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer x WHERE x.c_mktsegment = c.c_mktsegment)""")
def group_maximum(t):
    return tuple_in(t)


@query("ap_39_top_earners", "AP-39", sql="""
    SELECT n_name, c_name, c_acctbal FROM
      (SELECT *, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS r FROM customer)
    JOIN nation ON c_nationkey = n_nationkey WHERE r = 1""")
def top_earners(t):
    best = ordered.top_ranks(t.customer, ["c_nationkey"], ["-c_acctbal"], 1)
    return best.join(bounded_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_name", "c_acctbal")


@query("jn_17_tuple_equals", "JN-17", sql="""
    SELECT c_custkey, c_acctbal FROM customer
    WHERE c_nationkey = 5 AND c_acctbal = (SELECT max(c_acctbal) FROM customer WHERE c_nationkey = 5)""")
def tuple_equals(t):
    five = t.customer.filter("c_nationkey = 5")
    return five.filter(F.col("c_acctbal") == five.agg(F.max("c_acctbal")).scalar()).select("c_custkey", "c_acctbal")


ABOVE_MEAN = """SELECT c.c_custkey, c.c_acctbal FROM customer c JOIN
    (SELECT c_nationkey, sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM customer GROUP BY 1) m
    ON c.c_nationkey = m.c_nationkey AND c.c_acctbal > m.mean"""


def above_group_mean(df, group, value):
    """Rows whose value exceeds the mean of their group."""
    means = df.groupBy(group).agg(money_avg(value).alias("mean"))
    return skew_join(df, means, [group]).filter(F.col(value) > F.col("mean")).drop("mean")


@query("jn_18_join_aggregate", "JN-18", sql=ABOVE_MEAN)
def join_aggregate(t):
    return above_group_mean(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), "c_nationkey", "c_acctbal").drop("c_nationkey")


@query("sq_02_correlated_compare", "SQ-02", sql="""
    SELECT c_custkey, c_acctbal FROM customer c WHERE c_acctbal >
      (SELECT sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*) FROM customer x WHERE x.c_nationkey = c.c_nationkey)""")
def correlated_compare(t):
    return join_aggregate(t)


NEXT_ID = """WITH k AS (SELECT DISTINCT l_orderkey AS id FROM lineitem)"""


@query("jn_19_next_id", "JN-19", sql=NEXT_ID + """
    SELECT a.id, (SELECT min(b.id) FROM k b WHERE b.id > a.id) AS next_id FROM k a""")
def next_id(t):
    k = t.lineitem.select(F.col("l_orderkey").alias("id")).distinct()
    return ordered.framed(k, [], ["id"], {"next_id": lambda w: F.lead("id").over(w)}, after=1)


@query("jn_20_offset_self_join", "JN-20", sql="""
    SELECT a.event_type, a.event_id FROM events a JOIN events b ON b.event_id = a.event_id + 1
    JOIN events c ON c.event_id = a.event_id + 2 WHERE a.event_type = b.event_type AND b.event_type = c.event_type""")
def offset_self_join(t):
    e = t.events.select("event_id", "event_type")
    one = e.select((F.col("event_id") - 1).alias("event_id"), "event_type")
    two = e.select((F.col("event_id") - 2).alias("event_id"), "event_type")
    keys = ["event_id", "event_type"]
    return e.join(one, keys).join(two, keys).select("event_type", "event_id")


@query("jn_21_previous_day", "JN-21", sql="""
    WITH d AS (SELECT ts::DATE AS day, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1)
    SELECT a.day, a.total FROM d a JOIN d b ON b.day = a.day - 1 WHERE a.total > b.total""")
def previous_day(t):
    d = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.sum(money("value")).cast("double").alias("total"))
    before = d.select(F.date_add("day", 1).alias("day"), F.col("total").alias("earlier"))
    return d.join(before, "day").filter("total > earlier").select("day", "total")


@query("jn_22_unordered_pairs", "JN-22", sql="""
    WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day, event_type FROM events)
    SELECT a.event_type AS first_type, b.event_type AS second_type, count(*) AS days FROM d a JOIN d b
    ON a.user_id = b.user_id AND a.day = b.day AND a.event_type < b.event_type GROUP BY ALL""")
def unordered_pairs(t):
    # After DISTINCT a (user, day) holds one row per event type, so a hot user adds few rows.
    d = t.events.select("user_id", F.to_date("ts").alias("day"), "event_type").distinct()
    b = d.withColumnRenamed("event_type", "second_type")
    return (d.withColumnRenamed("event_type", "first_type").join(b, ["user_id", "day"]).filter("first_type < second_type")
            .groupBy("first_type", "second_type").agg(F.count("*").alias("days")))


@query("jn_23_scalar_relations", "JN-23", sql="""
    SELECT round((1 - f.n / nullif(a.n, 0)) * 100, 4) AS unfinished_pct, p.n AS pending, s.n AS suppliers
    FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F') f, (SELECT count(*) AS n FROM orders) a,
         (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P') p, (SELECT count(*) AS n FROM supplier) s""")
def scalar_relations(t):
    one = t.orders.agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"),
                       F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    return one.select(F.round((1 - F.col("f") / F.nullif(F.col("n"), F.lit(0))) * 100, 4).alias("unfinished_pct"), "pending",
                      t.supplier.agg(F.count("*")).scalar().alias("suppliers"))


HINTED = """SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


def hinted(t, hint):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    c = bounded_broadcast(c) if hint == "broadcast" else c.hint(hint)
    return t.orders.join(c, "o_custkey").groupBy("c_mktsegment", "o_orderstatus").agg(F.count("*").alias("n"))


@query("jn_24_hint_merge", "JN-24", sql=HINTED)
def hint_merge(t):
    return hinted(t, "merge")


@query("jn_24_hint_broadcast", "JN-24", sql=HINTED)
def hint_broadcast(t):
    return hinted(t, "broadcast")


@query("jn_25_lookups_per_row", "JN-25", sql=f"""
    WITH {EMP} SELECT n_name, (SELECT count(*) FROM emp WHERE dept_id = n_nationkey) AS headcount,
      (SELECT max(salary) FROM emp WHERE dept_id = n_nationkey) AS top_salary FROM nation""")
def lookups_per_row(t):
    stats = emp(t).groupBy("dept_id").agg(F.count("*").alias("n"), F.max("salary").alias("top_salary"))
    return (t.nation.join(stats, F.col("n_nationkey") == F.col("dept_id"), "left")
            .select("n_name", F.coalesce("n", F.lit(0)).alias("headcount"), "top_salary"))


@query("sq_01_scalar_subquery", "SQ-01", sql="""
    SELECT c_custkey, c_acctbal - (SELECT sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*) FROM customer) AS diff FROM customer
    WHERE c_acctbal > (SELECT sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*) FROM customer)""")
def scalar_subquery(t):
    mean = t.customer.agg(money_avg("c_acctbal")).scalar()
    return t.customer.filter(F.col("c_acctbal") > mean).select("c_custkey", (F.col("c_acctbal") - mean).alias("diff"))


@query("sq_03_derived_table", "SQ-03", sql="""
    SELECT * FROM (SELECT c_nationkey, sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM customer GROUP BY 1)
    WHERE mean > 4500""")
def derived_table(t):
    return t.customer.groupBy("c_nationkey").agg(money_avg("c_acctbal").alias("mean")).filter("mean > 4500")


@query("sq_04_cte_chain", "SQ-04", sql=f"""
    WITH {EMP}, {DEPT}, stats AS (SELECT dept_id, sum(salary::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM emp
      WHERE dept_id IS NOT NULL GROUP BY 1), best AS (SELECT dept_id FROM stats WHERE mean > 4600)
    SELECT e.name, e.salary, d.dept FROM emp e JOIN dept d ON e.dept_id = d.dept_id
    WHERE e.dept_id IN (SELECT dept_id FROM best)""")
def cte_chain(t):
    e = emp(t)
    best = (e.filter("dept_id IS NOT NULL").groupBy("dept_id").agg(money_avg("salary").alias("mean"))
            .filter("mean > 4600").select("dept_id"))
    return (e.join(best, "dept_id", "left_semi").join(bounded_broadcast(dept(t)), "dept_id").select("name", "salary", "dept"))


@query("sq_09_named_view", "SQ-09", sql="SELECT emp_id, name FROM (SELECT c_custkey AS emp_id, c_name AS name, c_acctbal FROM customer) WHERE c_acctbal > 9000")
def named_view(t):
    well_paid = emp(t).filter("salary > 9000")  # a view of its own name for each call, dropped after it
    return t.spark.sql("SELECT emp_id - 1 AS emp_id, name FROM {well_paid}", well_paid=well_paid)
