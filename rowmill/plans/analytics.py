"""Product analytics on the event feed. A session is a user's day; the page is the event type."""

from pyspark.sql import Window, functions as F

from rowmill.functions.money import money_avg, pct
from rowmill.operators import mutate, paging
from rowmill.operators.aggregates import share_of_total
from rowmill.plans.registry import query
from rowmill.sources.scan import latest

STEPS = ["view", "click", "signup", "purchase", "error"]


def daily_users(events):
    """Distinct users per day; (day, user) pairs are reduced before the count, so a hot day is spread by user."""
    return events.filter("user_id IS NOT NULL").groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("dau"))


@query("ap_18_daily_users", "AP-18", sql="""
    SELECT ts::DATE AS day, count(DISTINCT user_id) AS dau FROM events WHERE user_id IS NOT NULL
      AND ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY GROUP BY 1""")
def dau(t):
    return daily_users(t.events.filter(F.col("ts") >= latest(t.events, "ts", "30 DAYS")))


def funnel(events, session, steps):
    """Sessions that reached each step, in any order, and conversion from the first step."""
    flags = events.groupBy(*session).agg(*[F.max(F.when(F.col("event_type") == s, 1).otherwise(0)).alias(s) for s in steps])
    totals = flags.agg(*[F.sum(s).alias(s) for s in steps])
    return totals.select("*", pct(steps[1], steps[0]).alias("second_step_pct"), pct(steps[-1], steps[0]).alias("overall_pct"))


@query("ap_19_funnel", "AP-19", "AG-09", sql="""
    WITH s AS (SELECT user_id, ts::DATE AS day, """ + ", ".join(f"max((event_type = '{s}')::INT) AS {s}" for s in STEPS) + """ FROM events
      WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1, 2)
    SELECT """ + ", ".join(f"sum({s})::BIGINT AS {s}" for s in STEPS) + """, round(sum(click) / nullif(sum(view), 0) * 100, 2) AS second_step_pct,
      round(sum(error) / nullif(sum(view), 0) * 100, 2) AS overall_pct FROM s""")
def funnel_report(t):
    recent = t.events.filter(F.col("ts") >= latest(t.events, "ts", "7 DAYS"))
    return funnel(recent, ["user_id", F.to_date("ts").alias("day")], STEPS)


@query("ap_20_rolling_users", "AP-20", "WN-17", sql="""
    WITH d AS (SELECT ts::DATE AS day, count(DISTINCT user_id) AS dau FROM events WHERE user_id IS NOT NULL GROUP BY 1)
    SELECT day, dau, round((sum(dau) OVER w)::DOUBLE / (count(*) OVER w), 1) AS rolling_7d FROM d
    WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_users(t):
    w = Window.orderBy("day").rowsBetween(-6, 0)  # one row per day
    return daily_users(t.events).withColumn("rolling_7d", F.round(F.sum("dau").over(w) / F.count("*").over(w), 1))


@query("ap_21_top_pages", "AP-21", sql="""
    SELECT event_type AS page, count(*) AS page_views, count(DISTINCT (user_id, ts::DATE)) AS unique_sessions, count(DISTINCT user_id) AS unique_users,
      round(count(DISTINCT user_id) / count(DISTINCT (user_id, ts::DATE)) * 100, 2) AS login_rate_pct FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1 ORDER BY page_views DESC, page LIMIT 20""")
def top_pages(t):
    recent = t.events.filter(F.col("ts") >= latest(t.events, "ts", "7 DAYS"))
    # One row per (page, user, day) first: both distinct counts then need no expansion of the raw rows.
    days = recent.groupBy(F.col("event_type").alias("page"), "user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    users = days.groupBy("page", "user_id").agg(F.sum("n").alias("n"), F.count("*").alias("sessions"))
    pages = users.groupBy("page").agg(F.sum("n").alias("page_views"), F.sum("sessions").alias("unique_sessions"), F.count("user_id").alias("unique_users"))
    return paging.top_k(pages.withColumn("login_rate_pct", pct("unique_users", "unique_sessions")), ["-page_views", "page"], 20)


def daily_metric(events):
    return daily_users(events).select(F.col("day").alias("metric_date"), F.lit("dau").alias("metric_name"), F.lit("all").alias("dimension"),
                                      F.col("dau").alias("value"))


METRIC = "SELECT ts::DATE AS metric_date, 'dau' AS metric_name, 'all' AS dimension, count(DISTINCT user_id) AS value FROM events WHERE user_id IS NOT NULL {} GROUP BY 1"


@query("ap_22_metric_history", "AP-22", sql=METRIC.format(""))
def metric_history(t):
    return daily_metric(t.events)


@query("ap_22_metric_refresh", "AP-22", sql=METRIC.format(""))
def metric_refresh(t):
    """Yesterday's row is recomputed over a stored table with a wrong value for it; running twice changes nothing."""
    last_day = F.to_date(latest(t.events, "ts"))
    stale = daily_metric(t.events).withColumn("value", F.when(F.col("metric_date") == last_day, 0).otherwise(F.col("value")))
    fresh = daily_metric(t.events.filter(F.to_date("ts") == last_day))
    keys = ["metric_date", "metric_name", "dimension"]
    return mutate.upsert(mutate.upsert(stale, fresh, keys, ["value"]), fresh, keys, ["value"])


@query("ap_27_level_distribution", "AP-27", sql="""
    SELECT event_type, count(*) AS cnt, round(count(*) * 100.0 / (SELECT count(*) FROM events), 2) AS pct FROM events GROUP BY 1""")
def level_distribution(t):
    return share_of_total(t.events, ["event_type"])


@query("ap_28_slow_requests", "AP-28", sql="""
    SELECT event_type, count(*) AS slow_count, sum(value::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM events WHERE value > 20 GROUP BY 1""")
def slow_requests(t):
    return t.events.filter("value > 20").groupBy("event_type").agg(F.count("*").alias("slow_count"), money_avg("value").alias("mean"))
