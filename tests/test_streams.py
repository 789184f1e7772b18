"""Streams over files that arrive in parts must equal the batch queries on finished windows."""

import pytest
from pyspark.sql import functions as F

from rowmill.operators import islands
from rowmill.sources.scan import scan
from rowmill.streaming import feeds

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in time order, in four files that are read one per micro-batch."""
    folder = str(tmp_path_factory.mktemp("parts"))
    events = scan(spark, SF, "events").withColumn("p", F.ntile(4).over(__import__("pyspark.sql").sql.Window.orderBy("ts")))
    for i in range(1, 5):
        events.filter(F.col("p") == i).drop("p").coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    df = spark.readStream.schema(scan(spark, SF, "events").schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return df.withColumn("ts", feeds.zoned("ts"))


def closed_before(spark, delay):
    return scan(spark, SF, "events").agg(F.expr(f"max(ts) - INTERVAL {delay}")).first()[0]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_sessions(spark, parts, tmp_path):
    got = feeds.run_to_table(feeds.session_stream(stream(spark, parts)), str(tmp_path / "s"))
    batch = islands.sessions(scan(spark, SF, "events"), "user_id", "ts", "event_id").drop("session_no")
    cut = closed_before(spark, "10 MINUTES")
    want = batch.filter(F.col("session_end") + F.expr("INTERVAL 31 MINUTES") - F.expr("INTERVAL 0.000001 SECONDS") <= F.lit(cut))
    assert rows(got.select("user_id", "session_start", "session_end", "events")) == rows(
        want.select("user_id", "session_start", "session_end", "events")) and got.count() > 100


def test_rates(spark, parts, tmp_path):
    from rowmill.plans.scenarios import minute_counts
    got = feeds.run_to_table(feeds.rate_stream(stream(spark, parts)), str(tmp_path / "r"))
    cut = closed_before(spark, "5 MINUTES")
    want = minute_counts(scan(spark, SF, "events")).filter(F.col("window_start") + F.expr("INTERVAL 1 MINUTE") <= F.lit(cut))
    assert rows(got.select("user_id", "window_start", "requests")) == rows(want.select("user_id", "window_start", "requests"))


def test_daily_users_replay(spark, parts, tmp_path):
    table = feeds.DailyUsersTable(spark, str(tmp_path / "d"))
    got = table.run(stream(spark, parts))
    want = scan(spark, SF, "events").groupBy(F.to_date("ts").alias("metric_date")).agg(F.countDistinct("user_id").alias("value"))
    assert rows(got.select("metric_date", "value")) == rows(want)
    batch = scan(spark, SF, "events").withColumn("ts", feeds.zoned("ts"))
    table.upsert_batch(batch, 99)  # a replayed batch changes nothing
    assert rows(table.metrics().select("metric_date", "value")) == rows(want)


def test_streams_resume_and_finish(spark, tmp_path):
    """Two files, a stop after the first; then the mark that ends the input. All windows come out, each once."""
    events = scan(spark, SF, "events")
    middle = events.agg(F.expr("percentile_approx(unix_micros(to_timestamp_ltz(ts)), 0.5)")).first()[0]
    first = F.unix_micros(F.expr("to_timestamp_ltz(ts)")) <= middle
    parts, end = str(tmp_path / "parts"), str(tmp_path / "end")
    events.limit(0).coalesce(1).write.parquet(end)
    days = {}
    for k, some in enumerate([events.filter(first), events.filter(~first)]):
        some.coalesce(1).write.mode("append").parquet(parts)
        if k:
            feeds.close_input(events, end)
        source = lambda: feeds.event_stream(spark, parts, "*.parquet", end)
        sessions = feeds.run_to_table(feeds.session_stream(source()), str(tmp_path / "s"))
        rates = feeds.run_to_table(feeds.rate_stream(source()), str(tmp_path / "r"))
        days = feeds.DailyUsersTable(spark, str(tmp_path / "d")).run(feeds.event_stream(spark, parts, "*.parquet"))
    batch = islands.sessions(events, "user_id", "ts", "event_id").drop("session_no")
    assert rows(sessions.select("user_id", "session_start", "session_end", "events")) == rows(batch.select("user_id", "session_start", "session_end", "events"))
    assert rates.agg(F.sum("requests")).first()[0] == events.count()
    want = events.groupBy(F.to_date("ts").alias("metric_date")).agg(F.countDistinct("user_id").alias("value"))
    assert rows(days.select("metric_date", "value")) == rows(want)
