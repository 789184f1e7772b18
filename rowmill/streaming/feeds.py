"""Structured Streaming forms of the event queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.operators import mutate
from rowmill.session import entries, remove
from rowmill.sources.scan import SCHEMAS

SESSION_GAP = "1859 seconds 999999 microseconds"  # just under 31 minutes: gaps of up to 30 whole minutes stay in the session


EPOCH = "1970-01-01 00:00:00"


def zoned(column: str) -> Column:
    """A zone-free timestamp as the instant it names in UTC, whatever the session zone; watermarks need an instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(column)))


def naive(column: str) -> Column:
    """Back from an instant to the zone-free timestamp in UTC."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(column), F.lit(EPOCH).cast("timestamp_ntz"))


def event_stream(spark: SparkSession, folder: str, files: str = "events.parquet", end: str | None = None) -> DataFrame:
    """Events from the matching files of ``folder``, old and newly arriving; ``end`` is the folder of ``close_input``."""
    df = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", files).parquet(folder)
    if end is not None:
        df = df.unionByName(spark.readStream.schema(SCHEMAS["events"]).parquet(end))
    return df.withColumn("ts", zoned("ts"))


def close_input(events: DataFrame, end: str, later: str = "2 DAYS") -> None:
    """Declare an input finished: one empty event, ``later`` than all others, moves the watermark past every open window.

    A stream that reads ``end`` too then emits its last windows; that of the mark itself stays open. Events that arrive after it are late.
    """
    last = events.agg(F.expr(f"max(ts) + INTERVAL {later}").alias("ts")).filter("ts IS NOT NULL")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name != "ts"]
    last.select(*rest, "ts").select(*events.columns).write.mode("overwrite").parquet(end)


def session_stream(events: DataFrame, delay: str = "10 minutes", gap: str = SESSION_GAP) -> DataFrame:
    """Sessions per user, emitted once the watermark passes their end."""
    out = events.withWatermark("ts", delay).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("events"))
    return out.select("user_id", naive("session_start").alias("session_start"), naive("session_end").alias("session_end"), "events")


def rate_stream(events: DataFrame, delay: str = "5 minutes") -> DataFrame:
    """Requests per user and minute; the watermark drops state of old minutes."""
    out = events.withWatermark("ts", delay).groupBy("user_id", F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("requests"))
    return out.select("user_id", naive("w.start").alias("window_start"), "requests")


def velocity_stream(events: DataFrame, more_than: int, delay: str = "10 minutes") -> DataFrame:
    """Users with many events in an hour, one window every ten minutes."""
    out = events.withWatermark("ts", delay).groupBy("user_id", F.window("ts", "1 hour", "10 minutes").alias("w")).agg(
        F.count("*").alias("n")).filter(F.col("n") > more_than)
    return out.select("user_id", naive("w.start").alias("window_start"), "n")


def run_to_table(stream: DataFrame, base: str) -> DataFrame:
    """Process all files present, append finished results to the Parquet table in ``base``, return the table.

    ``base`` also holds the checkpoint: a later call with the same folder goes on where this one, or one that failed, stopped.
    """
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/table")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/table")


class DailyUsersTable:
    """Daily distinct users kept by a stream: every micro-batch adds its new (day, user) pairs and upserts the days it touched.

    Replaying a batch changes nothing: known pairs are skipped, and a day's
    value is counted again from its pairs. Each batch writes a version of the
    metrics, named by its number, from the last complete version of a lower
    number; older ones are removed. All state is in ``base``, so a new object
    on the same folder goes on where the last one stopped.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.pairs = spark, base, f"{base}/pairs"
        if "_SUCCESS" not in entries(spark, self.pairs):
            spark.createDataFrame([], "user_id bigint, day date").write.mode("overwrite").partitionBy("day").parquet(self.pairs)

    def _versions(self) -> list[int]:
        found = [int(n.removeprefix("metrics-")) for n in entries(self.spark, self.base) if n.startswith("metrics-")]
        return sorted(n for n in found if "_SUCCESS" in entries(self.spark, f"{self.base}/metrics-{n}"))

    def metrics(self, below: int | None = None) -> DataFrame:
        """The last complete version, of those below a batch number if given."""
        known = [n for n in self._versions() if below is None or n < below]
        if not known:
            return self.spark.createDataFrame([], "metric_date date, value bigint")
        return self.spark.read.schema("metric_date date, value bigint").parquet(f"{self.base}/metrics-{known[-1]}")

    def _pairs(self) -> DataFrame:
        return self.spark.read.schema("user_id bigint, day date").parquet(self.pairs)

    def upsert_batch(self, batch: DataFrame, epoch: int) -> None:
        seen = batch.filter("user_id IS NOT NULL").select("user_id", F.to_date(naive("ts")).alias("day")).distinct().persist()
        days = seen.select("day").distinct()
        known = self._pairs().join(F.broadcast(days), "day", "left_semi")  # only these day directories are read
        fresh = seen.join(known, ["user_id", "day"], "left_anti")
        fresh.write.partitionBy("day").mode("append").parquet(self.pairs)
        touched = self._pairs().join(F.broadcast(days), "day", "left_semi").groupBy(F.col("day").alias("metric_date")).agg(
            F.countDistinct("user_id").alias("value"))
        mutate.upsert(self.metrics(epoch), touched, ["metric_date"], ["value"]).write.mode("overwrite").parquet(f"{self.base}/metrics-{epoch}")
        for old in [n for n in self._versions() if n < epoch][:-1]:
            remove(self.spark, f"{self.base}/metrics-{old}")
        seen.unpersist()

    def run(self, events: DataFrame) -> DataFrame:
        query = (events.writeStream.foreachBatch(self.upsert_batch).option("checkpointLocation", f"{self.base}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return self.metrics()
