"""Hierarchies and summary refresh."""

from pyspark.sql import functions as F

from rowmill.functions.money import money_sum
from rowmill.operators import hierarchy, mutate
from rowmill.plans.bindings import BOM, EMP, bom, emp
from rowmill.plans.registry import query

ORG = f"""WITH RECURSIVE {EMP}, org AS (SELECT emp_id, name, 0 AS depth, name AS path FROM emp WHERE manager_id IS NULL
    UNION ALL SELECT e.emp_id, e.name, o.depth + 1, o.path || ' → ' || e.name FROM emp e JOIN org o ON e.manager_id = o.emp_id)"""


def org(t):
    return hierarchy.org_chart(emp(t).select("emp_id", "name", "manager_id"), "emp_id", "manager_id", "name")


@query("sq_05_org_chart", "SQ-05", sql=ORG + " SELECT emp_id, depth, path FROM org")
def org_chart(t):
    return org(t).select("emp_id", "depth", "path")


@query("sq_08_indented_tree", "SQ-08", sql=ORG + " SELECT emp_id, repeat('  ', depth) || name AS line FROM org")
def indented_tree(t):
    return org(t).select("emp_id", hierarchy.indented(F.col("name"), F.col("depth")).alias("line"))


@query("sq_06_ancestors", "SQ-06", sql=f"""
    WITH RECURSIVE {EMP}, up AS (SELECT emp_id AS start, emp_id, name, manager_id, 0 AS depth FROM emp WHERE salary > 9500
      UNION ALL SELECT u.start, e.emp_id, e.name, e.manager_id, u.depth + 1 FROM up u JOIN emp e ON e.emp_id = u.manager_id)
    SELECT start, emp_id, name, depth FROM up""")
def ancestors(t):
    e = emp(t)
    starts = e.filter("salary > 9500").select("emp_id")
    return hierarchy.ancestors(e.select("emp_id", "name", "manager_id"), "emp_id", "manager_id", starts).select("start", "emp_id", "name", "depth")


@query("sq_07_bill_of_materials", "SQ-07", sql=f"""
    WITH RECURSIVE {BOM}, tree AS (SELECT component_id, name, quantity::BIGINT AS total_needed, 1 AS level, name AS path FROM bom WHERE parent_id IS NULL
      UNION ALL SELECT b.component_id, b.name, b.quantity * x.total_needed, x.level + 1, x.path || ' > ' || b.name FROM bom b JOIN tree x ON b.parent_id = x.component_id)
    SELECT component_id, level, total_needed, path FROM tree""")
def bill_of_materials(t):
    out = hierarchy.exploded_parts(bom(t), "component_id", "parent_id", "name", "quantity")
    return out.select("component_id", "level", "total_needed", "path")


@query("sq_10_summary_refresh", "SQ-10", sql="""
    SELECT o_orderdate::DATE AS day, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue, count(*) AS orders FROM orders GROUP BY 1""")
def summary_refresh(t):
    """A stored summary without the last year, brought up to date by an upsert of the recent days."""
    def summary(df):
        return df.groupBy(F.to_date("o_orderdate").alias("day")).agg(money_sum("o_totalprice").alias("revenue"), F.count("*").alias("orders"))

    cut = F.lit("2000-06-01").cast("timestamp_ntz")
    stale = summary(t.orders.filter(F.col("o_orderdate") < F.lit("2000-07-01").cast("timestamp_ntz"))).withColumn(
        "orders", F.when(F.col("day") >= F.lit("2000-06-01").cast("date"), 0).otherwise(F.col("orders")))
    return mutate.upsert(stale, summary(t.orders.filter(F.col("o_orderdate") >= cut)), ["day"], ["revenue", "orders"])
