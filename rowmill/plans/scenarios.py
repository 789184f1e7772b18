"""Rate limits, leaderboards, link clicks, audits and parameterised lookups."""

from pyspark.sql import functions as F

from rowmill.functions.money import money, money_avg, money_sum
from rowmill.functions.scalar import start_of
from rowmill.operators import audit, filters, mutate, ordered
from rowmill.plans.bindings import EMP, emp
from rowmill.plans.registry import query
from rowmill.sources.scan import latest


def minute_counts(events):
    return events.groupBy("user_id", start_of("MINUTE", F.col("ts")).alias("window_start")).agg(F.count("*").alias("requests"))


@query("ap_29_rate_limit", "AP-29", sql="""
    SELECT user_id, date_trunc('minute', ts) AS window_start, count(*) AS requests, count(*) > 1 AS over_limit FROM events GROUP BY 1, 2""")
def rate_limit(t):
    return minute_counts(t.events).withColumn("over_limit", F.col("requests") > 1)


@query("ap_29_purge_windows", "AP-29", sql="""
    SELECT user_id, date_trunc('minute', ts) AS window_start, count(*) AS requests FROM events
    WHERE date_trunc('minute', ts) >= (SELECT max(ts) FROM events) - INTERVAL 300 MINUTE GROUP BY 1, 2""")
def purge_windows(t):
    # Only the kept windows are counted: the cutoff goes to the scan, whole minutes are dropped after it.
    cut = latest(t.events, "ts", "300 MINUTES")
    recent = minute_counts(t.events.filter(F.col("ts") >= cut))
    return mutate.delete(recent, F.col("window_start") < cut)


def scores(t):
    """Score per user and period: the last 7 days, the last 30 days, all time."""
    e = t.events
    week, month = latest(e, "ts", "7 DAYS"), latest(e, "ts", "30 DAYS")
    v = money("value")
    wide = e.groupBy("user_id").agg(F.sum(F.when(F.col("ts") >= week, v)).alias("weekly"), F.sum(F.when(F.col("ts") >= month, v)).alias("monthly"),
                                    F.sum(v).alias("alltime"))
    periods = F.array(*[F.struct(F.lit(p).alias("period"), F.col(p).alias("score")) for p in ("weekly", "monthly", "alltime")])
    return wide.select("user_id", F.explode(periods).alias("p")).select("user_id", "p.*").filter("score IS NOT NULL")


SCORES = """s AS (SELECT 'weekly' AS period, user_id, sum(value::DECIMAL(18,2)) AS score FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 2
    UNION ALL SELECT 'monthly', user_id, sum(value::DECIMAL(18,2)) FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY GROUP BY 2
    UNION ALL SELECT 'alltime', user_id, sum(value::DECIMAL(18,2)) FROM events GROUP BY 2)"""


@query("ap_30_leaderboard", "AP-30", sql=f"""
    WITH {SCORES} SELECT period, user_id, score::DOUBLE AS score, rank() OVER (PARTITION BY period ORDER BY score DESC) AS global_rank FROM s""")
def leaderboard(t):
    out = ordered.ranks(scores(t), ["period"], ["-score"], rank="global_rank")
    return out.select("period", "user_id", F.col("score").cast("double").alias("score"), "global_rank")


@query("ap_31_single_rank", "AP-31", sql=f"""
    WITH {SCORES} SELECT count(*) + 1 AS user_rank FROM s WHERE period = 'weekly' AND score > (SELECT score FROM s WHERE user_id = 3 AND period = 'weekly')""")
def single_rank(t):
    weekly = scores(t).filter("period = 'weekly'")
    mine = weekly.filter("user_id = 3").select("score").scalar()
    return weekly.filter(F.col("score") > mine).agg((F.count("*") + 1).alias("user_rank"))


@query("ap_32_link_clicks", "AP-32", sql="""
    SELECT user_id AS code, event_type AS country, ts::DATE AS day, count(*) AS clicks FROM events GROUP BY 1, 2, 3""")
def link_clicks(t):
    return t.events.groupBy(F.col("user_id").alias("code"), F.col("event_type").alias("country"), F.to_date("ts").alias("day")).agg(F.count("*").alias("clicks"))


@query("ap_32_live_links", "AP-32", sql="""
    SELECT c_custkey AS code, coalesce(n, 0) AS clicks FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (c_custkey % 60) END AS expires_at FROM customer)
    LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON c_custkey = user_id
    WHERE expires_at IS NULL OR expires_at > (SELECT max(ts) FROM events)""")
def live_links(t):
    expires = F.when(F.col("c_custkey") % 3 != 0, F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") * (F.col("c_custkey") % 60))
    links = t.customer.select(F.col("c_custkey").alias("code"), expires.alias("expires_at"))
    clicks = t.events.groupBy(F.col("user_id").alias("code")).agg(F.count("*").alias("n"))
    live = links.filter(F.col("expires_at").isNull() | (F.col("expires_at") > latest(t.events, "ts")))
    return live.join(clicks, "code", "left").select("code", F.coalesce("n", F.lit(0)).alias("clicks"))


REPORT = """SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus = 'F' GROUP BY 1"""


@query("ap_33_yearly_report", "AP-33", sql=REPORT)
def yearly_report(t):
    return t.orders.filter(filters.year_range("o_orderdate", 1998) & (F.col("o_orderstatus") == "F")).groupBy("o_custkey").agg(
        money_sum("o_totalprice").alias("revenue"))


@query("ap_33_report_from_summary", "AP-33", sql=REPORT)
def report_from_summary(t):
    """The same report from a daily summary by customer and status."""
    daily = t.orders.groupBy("o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("revenue"))
    wanted = F.col("day").between(F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date")) & (F.col("o_orderstatus") == "F")
    return daily.filter(wanted).groupBy("o_custkey").agg(F.sum("revenue").cast("double").alias("revenue"))


@query("ap_34_audit_trail", "AP-34", sql="""
    WITH a AS (SELECT o_orderkey AS k, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0),
      b AS (SELECT o_orderkey AS k, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE nullif(o_orderstatus, 'P') END AS o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0)
    SELECT 'orders' AS table_name, coalesce(a.k, b.k) AS record_id, CASE WHEN a.k IS NULL THEN 'INSERT' WHEN b.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
      CASE WHEN a.k IS NOT NULL THEN json_object('o_custkey', a.o_custkey, 'o_orderstatus', a.o_orderstatus)::VARCHAR END AS old_values,
      CASE WHEN b.k IS NOT NULL THEN json_object('o_custkey', b.o_custkey, 'o_orderstatus', b.o_orderstatus)::VARCHAR END AS new_values
    FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def audit_trail(t):
    d = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    status = F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return audit.changes(d.filter("o_orderkey % 5 <> 0"), d.filter("o_orderkey % 7 <> 0").withColumn("o_orderstatus", status),
                         "o_orderkey", ["o_custkey", "o_orderstatus"], "orders")


RAISES = """j AS (SELECT c_custkey, c_acctbal AS old_value, c_acctbal * (c_custkey % 4) AS new_value FROM customer),
    v AS (SELECT *, CASE WHEN new_value < 0 THEN 'negative' WHEN new_value > old_value * 2 THEN 'more than doubled' ELSE 'accepted' END AS verdict FROM j)"""


def judged(t):
    proposals = t.customer.select("c_custkey", (F.col("c_acctbal") * (F.col("c_custkey") % 4)).alias("c_acctbal"))
    return audit.judge_raises(t.customer, proposals, "c_custkey", "c_acctbal")


@query("ap_35_checked_update", "AP-35", sql=f"WITH {RAISES} SELECT c_custkey, verdict FROM v")
def checked_update(t):
    return judged(t).select("c_custkey", "verdict")


@query("ap_35_update_audit", "AP-35", sql=f"""
    WITH {RAISES} SELECT c_custkey, old_value, new_value, 'SALARY_CHANGE' AS action FROM v WHERE verdict = 'accepted' AND old_value <> new_value""")
def update_audit(t):
    return audit.raise_audit(judged(t))


@query("ap_36_transfer_audit", "AP-36", sql=f"""
    WITH {EMP} SELECT emp_id, 'Transferred to dept ' || 9 AS action, (SELECT max(o_orderdate) FROM orders) AS changed_at FROM emp WHERE salary > 9500 AND dept_id IS NOT NULL
    UNION ALL SELECT dept_id, 'members', NULL FROM (SELECT CASE WHEN salary > 9500 AND dept_id IS NOT NULL THEN 9 ELSE dept_id END AS dept_id FROM emp)""")
def transfer_audit(t):
    """Move the best paid to department 9, log each move; the new members follow as extra rows."""
    e = emp(t)
    moved = (F.col("salary") > 9500) & F.col("dept_id").isNotNull()
    after = mutate.update(e, {"dept_id": F.lit(9)}, moved)
    log = e.filter(moved).select("emp_id", F.lit("Transferred to dept 9").alias("action"), latest(t.orders, "o_orderdate").alias("changed_at"))
    members = after.select(F.col("dept_id").cast("bigint").alias("emp_id"), F.lit("members").alias("action"), F.lit(None).cast("timestamp_ntz").alias("changed_at"))
    return mutate.append(log, members)


@query("ap_37_staff_of_department", "AP-37", sql=f"WITH {EMP} SELECT emp_id, name, salary FROM emp WHERE dept_id = 3")
def staff_of_department(t, department: int = 3):
    emp(t).createOrReplaceTempView("rowmill_emp")
    return t.spark.sql("SELECT emp_id, name, salary FROM rowmill_emp WHERE dept_id = :department ORDER BY salary DESC", args={"department": department})


@query("ap_37_department_stats", "AP-37", sql=f"""
    WITH {EMP} SELECT count(*) AS headcount, sum(salary::DECIMAL(18,2))::DOUBLE / count(*) AS avg_salary FROM emp WHERE dept_id = 3""")
def department_stats(t, department: int = 3):
    return emp(t).filter(F.col("dept_id") == department).agg(F.count("*").alias("headcount"), money_avg("salary").alias("avg_salary"))
