"""Constraint checks on the input tables."""

from itertools import combinations

from pyspark.sql import functions as F

from rowmill.functions.money import money
from rowmill.operators.joins import bounded_broadcast
from rowmill.operators import mutate, quality
from rowmill.plans.registry import query


@query("dq_01_primary_key", "DQ-01", sql="""
    SELECT l_orderkey, k, count(*) AS copies FROM (SELECT l_orderkey, nullif(l_linenumber, 7) AS k FROM lineitem)
    GROUP BY ALL HAVING count(*) > 1 OR k IS NULL OR l_orderkey IS NULL""")
def primary_key(t):
    return quality.check_primary_key(t.lineitem.select("l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(7)).alias("k")), ["l_orderkey", "k"])


@query("dq_02_unique", "DQ-02", sql="""
    SELECT c_nationkey, email, count(*) AS copies FROM (SELECT c_nationkey, nullif(c_mktsegment, 'MACHINERY') AS email FROM customer)
    WHERE c_nationkey IS NOT NULL AND email IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def unique(t):
    return quality.check_unique(t.customer.select("c_nationkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("email")), ["c_nationkey", "email"])


@query("dq_03_not_null", "DQ-03", sql="SELECT c_custkey FROM customer WHERE nullif(c_nationkey, 3) IS NULL")
def not_null(t):
    return quality.check_not_null(t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("k")), ["k"]).select("c_custkey")


@query("dq_04_foreign_key", "DQ-04", sql="SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def foreign_key(t):
    return quality.check_foreign_key(t.orders.select("o_orderkey"), "o_orderkey", t.lineitem, "l_orderkey")


@query("dq_05_rule", "DQ-05", sql="SELECT c_custkey, c_acctbal FROM customer WHERE NOT coalesce(nullif(c_acctbal, 0) >= -500, true)")
def rule(t):
    return quality.check_rule(t.customer.select("c_custkey", "c_acctbal"), F.nullif(F.col("c_acctbal"), F.lit(0.0)) >= -500)


@query("dq_06_domain", "DQ-06", sql="SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def domain(t):
    return quality.check_domain(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


def gone(t):
    return t.customer.filter("c_acctbal < 0").select("c_custkey")


@query("dq_07_cascade", "DQ-07", sql="SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def cascade(t):
    return quality.delete_cascade(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", gone(t)).select("o_orderkey", "o_custkey")


@query("dq_07_set_null", "DQ-07", sql="""
    SELECT o_orderkey, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN o_custkey END AS o_custkey FROM orders""")
def set_null(t):
    return quality.delete_set_null(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", gone(t))


@query("dq_07_restrict", "DQ-07", sql="SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def restrict(t):
    return quality.delete_restrict(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", gone(t)).select("o_orderkey", "o_custkey")


@query("dq_07_update_cascade", "DQ-07", sql="""
    SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN o_custkey + 1000000 ELSE o_custkey END AS o_custkey FROM orders""")
def update_cascade(t):
    moved = gone(t).select("c_custkey", (F.col("c_custkey") + 1000000).alias("new"))
    return quality.update_cascade(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", moved)


@query("dq_09_dependency", "DQ-09", sql="SELECT p_name FROM part GROUP BY 1 HAVING count(DISTINCT (p_brand, p_type)) > 1")
def dependency(t):
    return quality.check_dependency(t.part, ["p_name"], ["p_brand", "p_type"])


@query("dq_10_candidate_keys", "DQ-10", sql="""
    WITH c AS (SELECT count(*) AS n, count(DISTINCT n_nationkey) AS a, count(DISTINCT c_custkey) AS b, count(DISTINCT c_acctbal) AS c,
      count(DISTINCT (n_nationkey, c_custkey)) AS ab, count(DISTINCT (n_nationkey, c_acctbal)) AS ac, count(DISTINCT (c_custkey, c_acctbal)) AS bc
      FROM (SELECT c_nationkey AS n_nationkey, c_custkey, c_acctbal FROM customer))
    SELECT 'c_nationkey' AS columns, a = n AS is_superkey, a = n AS is_candidate FROM c UNION ALL SELECT 'c_custkey', b = n, b = n FROM c
    UNION ALL SELECT 'c_acctbal', c = n, c = n FROM c UNION ALL SELECT 'c_nationkey,c_custkey', ab = n, ab = n AND NOT (a = n OR b = n) FROM c
    UNION ALL SELECT 'c_nationkey,c_acctbal', ac = n, ac = n AND NOT (a = n OR c = n) FROM c
    UNION ALL SELECT 'c_custkey,c_acctbal', bc = n, bc = n AND NOT (b = n OR c = n) FROM c""")
def candidate_keys(t):
    return quality.column_keys(t.customer, ["c_nationkey", "c_custkey", "c_acctbal"], 2)


WIDE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


def _sets_sql() -> str:
    """(columns, list of them, is_superkey) for each set of up to three columns of WIDE."""
    sets = [s for w in (1, 2, 3) for s in combinations(WIDE, w)]
    one = "SELECT '{0}' AS columns, {1} AS cs, (SELECT count(*) FROM (SELECT DISTINCT {0} FROM lineitem)) = (SELECT count(*) FROM lineitem) AS is_superkey"
    return " UNION ALL ".join(one.format(",".join(s), list(s)) for s in sets)


@query("dq_10_wide_keys", "DQ-10", sql=f"""
    WITH s AS ({_sets_sql()}) SELECT columns, is_superkey, is_superkey AND NOT EXISTS (SELECT 1 FROM s AS x WHERE x.is_superkey AND len(x.cs) < len(s.cs)
      AND list_has_all(s.cs, x.cs)) AS is_candidate FROM s""")
def wide_keys(t):
    return quality.column_keys(t.lineitem.select(*WIDE), WIDE, 3)


@query("dq_11_normal_form", "DQ-11", sql="""
    WITH d AS (SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT 'n_name' AS determinant, 'n_regionkey' AS dependent, (SELECT max(x) = 1 FROM (SELECT count(DISTINCT n_regionkey) AS x FROM d GROUP BY n_name)) AS holds,
      (SELECT count(*) > count(DISTINCT n_name) FROM d) AND (SELECT max(x) = 1 FROM (SELECT count(DISTINCT n_regionkey) AS x FROM d GROUP BY n_name)) AS violates
    UNION ALL SELECT 'c_custkey', 'n_name', true, false UNION ALL SELECT 'n_regionkey', 'n_name', false, false""")
def normal_form(t):
    d = t.customer.join(bounded_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "n_regionkey")
    return quality.normal_form_violations(d, [(["n_name"], ["n_regionkey"]), (["c_custkey"], ["n_name"]), (["n_regionkey"], ["n_name"])])


@query("dq_12_same_total", "DQ-12", sql="""
    SELECT sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS "before", sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS after, true AS balanced FROM customer""")
def same_total(t):
    """Move 10 from every even to the next odd account: the total stays."""
    d = t.customer.select("c_custkey", money("c_acctbal").alias("balance"))
    moved = mutate.update(d, {"balance": F.col("balance") + F.when(F.col("c_custkey") % 2 == 0, -10).otherwise(10)}, F.lit(True))
    return quality.same_total(d, moved, F.col("balance"))
