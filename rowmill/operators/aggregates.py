"""Aggregation helpers that go beyond one groupBy."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.operators.ordered import number_rows, running_sums, totals
from rowmill.session import file_sizes


def joined_text(df: DataFrame, keys: list[str], column: str, order: list[str], sep: str = ", ",
                per_line: int = 1000, name: str = "listing") -> DataFrame:
    """Ordered string aggregation: one row per group.

    The text is put together from lines of ``per_line`` values, so only the last step meets a whole group, as its joined
    text. ``order`` must be unique within the group.
    """
    lines = joined_lines(df, keys, column, order, sep, per_line, name)
    parts = F.sort_array(F.collect_list(F.struct("line", F.col(name).alias("v"))))
    return lines.groupBy(*keys).agg(F.array_join(parts["v"], sep).alias(name))


def joined_lines(df: DataFrame, keys: list[str], column: str, order: list[str], sep: str = ", ",
                 per_line: int = 1000, name: str = "listing") -> DataFrame:
    """Ordered string aggregation, at most ``per_line`` values per output row.

    A group that fits one line gives one row with line 1. A larger group goes
    on over several lines, in order, so no task ever holds a whole hot group.
    ``order`` must be unique within the group.
    """
    rows = number_rows(df.filter(F.col(column).isNotNull()), keys, order, "_rn")
    rows = rows.withColumn("line", (F.floor((F.col("_rn") - 1) / per_line) + 1).cast("bigint"))
    parts = F.sort_array(F.collect_list(F.struct("_rn", F.col(column).cast("string").alias("v"))))
    return rows.groupBy(*keys, "line").agg(F.array_join(parts["v"], sep).alias(name))


def pivot_sums(df: DataFrame, keys: list[str], column: str, values: Iterable, measure: Column,
               total: str = "total") -> DataFrame:
    """One column per listed value with the sum of ``measure``, 0 where absent, plus the row total."""
    values = list(values)
    df = df.withColumn("_m", measure)
    cells = [F.coalesce(F.sum(F.when(F.col(column) == v, F.col("_m"))), F.lit(0)).alias(str(v)) for v in values]
    return df.groupBy(*keys).agg(*cells, F.sum("_m").alias(total))


def share_of_total(df: DataFrame, keys: list[str], digits: int = 2) -> DataFrame:
    """Count per key and its percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("cnt"))
    return totals(counts, [], {"_all": F.sum("cnt")}).select(
        *keys, "cnt", F.round(F.col("cnt") * 100.0 / F.col("_all"), digits).alias("pct"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: NULL count and row count, in one pass."""
    columns = columns or df.columns
    one = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    return one.select(F.explode(cells).alias("c"), "_rows").select("c.column_name", "c.nulls", F.col("_rows").alias("row_count"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def prefix_selectivity(df: DataFrame, column: str, lengths: Iterable[int]) -> DataFrame:
    """Distinct share of the first n characters for each n, and of the full value, as one row."""
    # Copies fall away first; the distinct counts then expand the distinct values only.
    c, rows = F.col(column), F.sum("_n")
    values = df.groupBy(column).agg(F.count("*").alias("_n"))
    parts = [(F.countDistinct(F.left(c, F.lit(n))) / rows).alias(f"sel_{n}") for n in lengths]
    return values.agg(*parts, (F.count(c) / rows).alias("sel_full"))


def cardinality(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row per column: distinct values and their share of the rows."""
    counter = F.approx_count_distinct if approximate else F.countDistinct
    one = df.agg(F.count("*").alias("_rows"), *[counter(c).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("cardinality")) for c in columns])
    return (one.select(F.explode(cells).alias("c"), "_rows")
            .select("c.column_name", "c.cardinality", (F.col("c.cardinality") / F.col("_rows")).alias("selectivity")))


def singleton_histogram(df: DataFrame, column: str) -> DataFrame:
    """Frequency and cumulative share of each value, for columns with few distinct values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("cnt"))
    out = totals(running_sums(counts, [], [column], {"_upto": F.col("cnt")}), [], {"_all": F.sum("cnt")})
    return out.select(column, "cnt", (F.col("_upto") / F.col("_all")).alias("cumulative"))


def height_histogram(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Equi-height buckets; a value is never split over two buckets."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    out = totals(running_sums(counts, [], [column], {"_upto": F.col("_n")}), [], {"_all": F.sum("_n")})
    bucket = F.floor((F.col("_upto") - 1) * buckets / F.col("_all")) + 1
    return out.groupBy(bucket.cast("bigint").alias("bucket")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.sum("_n").alias("cnt"), F.count("*").alias("values"))


def histogram(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Singleton buckets where at most ``buckets`` values exist, else equi-height buckets."""
    few = df.select(column).distinct().limit(buckets + 1).count() <= buckets
    return singleton_histogram(df, column) if few else height_histogram(df, column, buckets)


def bought_by_all(df: DataFrame, items: list[str], member: str, everyone: DataFrame) -> DataFrame:
    """Relational division: items whose distinct members number as many as ``everyone`` has rows."""
    size = everyone.agg(F.count("*")).scalar()
    counts = df.groupBy(*items).agg(F.countDistinct(member).alias("_n"))
    return counts.filter(F.col("_n") == size).drop("_n")


def footer_rows(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, bytes, rows) of Parquet files, from their footers: no column is read."""
    found = spark.read.parquet(*files).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return found.groupBy("path", "bytes").agg(F.count("*").alias("rows"))


def rough_count(table: DataFrame, files: int = 100, sizes: Callable[[SparkSession, list[str]], dict[str, int]] = file_sizes) -> tuple[int, int]:
    """(estimated rows, margin) of a plain scan of a stored table, from the footers of a sample of ``files`` files, chosen by a hash of their names.

    Rows per byte of the sample times the bytes of all. The margin is four standard errors, from how far the files' rows lie off that rate;
    it is 0 when all files were read, and a frame without files is counted.
    """
    names = table.inputFiles()
    if not names:
        return table.count(), 0
    spark = table.sparkSession
    some = sorted(names, key=lambda n: hashlib.md5(n.encode()).digest())[:files]
    read = footer_rows(spark, some).collect()
    rows, size = sum(r["rows"] for r in read), sum(r["bytes"] for r in read)
    if len(some) == len(names):
        return rows, 0
    total = sum(sizes(spark, names).values())
    rate = rows / size if size else 0.0
    off = sum((r["rows"] - rate * r["bytes"]) ** 2 for r in read) / max(1, len(some) - 1)
    margin = 4 * len(names) * math.sqrt(off / len(some) * (1 - len(some) / len(names)))
    return round(rate * total), math.ceil(margin)
