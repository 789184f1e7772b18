"""Streaming queries over the event files, run until all files are read and the input is declared finished."""

import uuid

from pyspark.sql import functions as F

from rowmill.plans.registry import query
from rowmill.plans.windowing import session_sql
from rowmill.session import shared_folder
from rowmill.streaming import feeds


def new_folder(t) -> str:
    return f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"


def finished(t, form):
    """All windows of a finished input."""
    base = new_folder(t)
    feeds.close_input(t.events, f"{base}/end")
    return feeds.run_to_table(form(feeds.event_stream(t.spark, t.folder, end=f"{base}/end")), base)


@query("st_01_session_stream", "ST-01", sql=f"""
    SELECT user_id, session_start, session_end, events FROM ({session_sql(30)})""")
def session_stream(t):
    return finished(t, feeds.session_stream)


@query("st_02_rate_stream", "ST-02", sql="""
    SELECT user_id, date_trunc('minute', ts) AS window_start, count(*) AS requests, count(*) > 1 AS over_limit FROM events GROUP BY 1, 2""")
def rate_stream(t):
    out = finished(t, feeds.rate_stream)
    return out.withColumn("over_limit", F.col("requests") > 1)


@query("st_03_velocity_stream", "ST-03", sql="""
    WITH w AS (SELECT user_id, time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 10 MINUTE * k AS window_start FROM events, range(6) r(k))
    SELECT user_id, window_start, count(*) AS n FROM w
    GROUP BY 1, 2 HAVING count(*) > 1""")
def velocity_stream(t):
    return finished(t, lambda events: feeds.velocity_stream(events, 1))


@query("st_04_metric_stream", "ST-04", sql="""
    SELECT ts::DATE AS metric_date, count(DISTINCT user_id) AS value FROM events WHERE user_id IS NOT NULL GROUP BY 1""")
def metric_stream(t):
    return feeds.DailyUsersTable(t.spark, new_folder(t)).run(feeds.event_stream(t.spark, t.folder))
