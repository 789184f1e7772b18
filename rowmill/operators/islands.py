"""Gaps, islands and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.ordered import framed, number_rows, running_sums, totals


def whole_minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes, truncated to whole ones."""
    return F.timestamp_diff("MINUTE", start, end)


def mark_sessions(df: DataFrame, user: str, ts: str, key: str, gap_minutes: int = 30,
                  name: str = "session_no") -> DataFrame:
    """Number the sessions of each user: a gap of more than ``gap_minutes`` whole minutes starts one."""
    df = framed(df, [user], [ts, key], {"_prev": lambda w: F.lag(ts).over(w)}, before=1)
    gap = whole_minutes(F.col("_prev"), F.col(ts))
    starts = F.when(gap.isNull() | (gap > gap_minutes), 1).otherwise(0)
    return running_sums(df, [user], [ts, key], {name: starts}).drop("_prev")


def sessions(df: DataFrame, user: str, ts: str, key: str, gap_minutes: int = 30) -> DataFrame:
    marked = mark_sessions(df, user, ts, key, gap_minutes)
    return marked.groupBy(user, "session_no").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("events"))


def streaks(df: DataFrame, user: str, day: str) -> DataFrame:
    """Runs of consecutive days per user. After DISTINCT a user has at most one row per calendar day."""
    days = number_rows(df.select(user, day).distinct(), [user], [day], "_rn")
    days = days.withColumn("_run", F.date_sub(day, F.col("_rn").cast("int")))
    return days.groupBy(user, "_run").agg(F.min(day).alias("streak_start"), F.max(day).alias("streak_end"),
                                          F.count("*").alias("days")).drop("_run")


def islands(df: DataFrame, column: str) -> DataFrame:
    """Mark maximal runs of consecutive integers; ``_island`` is the same within a run."""
    return number_rows(df, [], [column], "_rn").withColumn("_island", F.col(column) - F.col("_rn")).drop("_rn")


def runs_of(df: DataFrame, column: str, at_least: int = 1) -> DataFrame:
    """First, last and length of each run of consecutive integers in ``column``."""
    marked = islands(df.select(column).distinct(), column)
    out = marked.groupBy("_island").agg(F.min(column).alias("run_start"), F.max(column).alias("run_end"),
                                        F.count("*").alias("run_length")).drop("_island")
    return out.filter(F.col("run_length") >= at_least)


def rows_in_long_runs(df: DataFrame, column: str, at_least: int) -> DataFrame:
    """Rows (one per value of ``column``) that belong to a run of at least ``at_least`` consecutive values."""
    marked = totals(islands(df, column), ["_island"], {"_len": F.count("*")})
    return marked.filter(F.col("_len") >= at_least).drop("_island", "_len")


def gaps(df: DataFrame, column: str) -> DataFrame:
    """Missing ranges between consecutive values."""
    out = framed(df.select(column).distinct(), [], [column], {"_next": lambda w: F.lead(column).over(w)}, after=1)
    return (out.filter(F.col("_next") > F.col(column) + 1)
            .select((F.col(column) + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end")))


def equal_runs(df: DataFrame, key: str, value: str, length: int = 3) -> DataFrame:
    """Values that appear in ``length`` rows with consecutive keys."""
    checks = {}
    for i in range(1, length):
        checks[f"_k{i}"] = lambda w, i=i: F.lag(key, i).over(w)
        checks[f"_v{i}"] = lambda w, i=i: F.lag(value, i).over(w)
    df = framed(df.select(key, value), [], [key], checks, before=length - 1)
    same = F.lit(True)
    for i in range(1, length):
        same = same & (F.col(f"_k{i}") == F.col(key) - i) & (F.col(f"_v{i}") == F.col(value))
    return df.filter(same).select(value).distinct()
