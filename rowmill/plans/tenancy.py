"""Multi-tenant reports: nations are tenants, customers their users, suppliers their projects."""

from pyspark.sql import functions as F

from rowmill.functions import udf
from rowmill.plans.registry import query
from rowmill.plans.scalars import LIMIT_SQL, PLAN_SQL, plan_of
from rowmill.sources.scan import latest

TENANT = "tenant AS (SELECT n_nationkey AS tenant_id, n_name AS tenant, " + PLAN_SQL.format("n_nationkey") + " AS plan FROM nation)"


def tenants(t):
    return t.nation.select(F.col("n_nationkey").alias("tenant_id"), F.col("n_name").alias("tenant"), plan_of("n_nationkey").alias("plan"))


@query("ap_23_cross_tenant", "AP-23", sql=f"""
    WITH {TENANT} SELECT tenant, plan, count(DISTINCT c_custkey) AS user_count, count(DISTINCT s_suppkey) AS project_count FROM tenant
    LEFT JOIN customer ON c_nationkey = tenant_id AND c_acctbal > 9000 LEFT JOIN supplier ON s_nationkey = tenant_id AND s_acctbal > 0 GROUP BY 1, 2""")
def cross_tenant(t):
    # Each side is counted first; joining both raw sides would multiply users by projects.
    users = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("tenant_id")).agg(F.countDistinct("c_custkey").alias("u"))
    projects = t.supplier.filter("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("tenant_id")).agg(F.countDistinct("s_suppkey").alias("p"))
    out = tenants(t).join(users, "tenant_id", "left").join(projects, "tenant_id", "left")
    return out.select("tenant", "plan", F.coalesce("u", F.lit(0)).alias("user_count"), F.coalesce("p", F.lit(0)).alias("project_count"))


@query("ap_24_usage_report", "AP-24", sql=f"""
    WITH {TENANT}, u AS (SELECT c_nationkey AS tenant_id, o_orderdate AS day, count(*) AS calls, max(o_totalprice) AS storage, count(DISTINCT o_custkey) AS users
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY GROUP BY 1, 2)
    SELECT tenant, plan, sum(calls)::BIGINT AS total_calls, max(storage) AS current_storage, arg_max(storage, day) AS latest_storage,
      sum(users)::DOUBLE / count(*) AS avg_users FROM tenant JOIN u ON tenant.tenant_id = u.tenant_id GROUP BY 1, 2""")
def usage_report(t):
    recent = t.orders.filter(F.col("o_orderdate") >= latest(t.orders, "o_orderdate", "30 DAYS")).select("o_custkey", "o_orderdate", "o_totalprice")
    joined = recent.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("tenant_id")), "o_custkey")
    usage = joined.groupBy("tenant_id", F.col("o_orderdate").alias("day")).agg(
        F.count("*").alias("calls"), F.max("o_totalprice").alias("storage"), F.countDistinct("o_custkey").alias("users"))
    report = usage.groupBy("tenant_id").agg(F.sum("calls").alias("total_calls"), F.max("storage").alias("current_storage"),
                                            F.max_by("storage", "day").alias("latest_storage"), (F.sum("users") / F.count("*")).alias("avg_users"))
    return tenants(t).join(report, "tenant_id").drop("tenant_id")


@query("ap_25_plan_limits", "AP-25", "PF-20", sql=f"""
    WITH {TENANT}, c AS (SELECT tenant_id, plan, count(c_custkey) AS current_users FROM tenant LEFT JOIN customer
      ON c_nationkey = tenant_id AND c_acctbal > 5000 GROUP BY 1, 2)
    SELECT *, {LIMIT_SQL.format('plan')}::INT AS max_users, current_users >= {LIMIT_SQL.format('plan')} AS at_limit FROM c""")
def plan_limits(t):
    users = t.customer.filter("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("tenant_id")).agg(F.count("*").alias("n"))
    out = tenants(t).join(users, "tenant_id", "left").select("tenant_id", "plan", F.coalesce("n", F.lit(0)).alias("current_users"))
    out = out.withColumn("max_users", udf.plan_limit(F.col("plan"), F.lit("max_users")))
    return out.withColumn("at_limit", F.col("current_users") >= F.col("max_users"))


@query("ap_26_cancellation_rate", "AP-26", "AG-10", sql="""
    WITH trip AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, min(l_suppkey) AS driver FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4)
    SELECT o_orderdate AS day, round(sum((o_orderstatus <> 'F')::INT)::DOUBLE / count(*), 2) AS cancellation_rate FROM trip
    JOIN customer ON o_custkey = c_custkey AND c_custkey % 7 <> 0 JOIN supplier ON driver = s_suppkey AND s_suppkey % 7 <> 0
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-10-01' AND TIMESTAMP '1996-12-31' GROUP BY 1""")
def cancellation_rate(t):
    day = F.col("o_orderdate")
    inside = day.between(F.lit("1996-10-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz"))
    asked = t.orders.filter(inside).select(F.col("o_orderkey").alias("l_orderkey"))
    drivers = (t.lineitem.select("l_orderkey", "l_suppkey").join(asked, "l_orderkey", "left_semi")
               .groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("driver")))
    clients = t.customer.filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    allowed = t.supplier.filter("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("driver"))
    trips = (t.orders.filter(inside).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
             .join(clients, "o_custkey", "left_semi").join(drivers, "o_orderkey").join(allowed, "driver", "left_semi"))
    return trips.groupBy(day.alias("day")).agg(F.round(F.count_if(F.col("o_orderstatus") != "F") / F.count("*"), 2).alias("cancellation_rate"))
