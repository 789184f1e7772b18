"""Partitioned layouts and shard routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.functions.scalar import constant
from rowmill.operators.joins import skew_join


def range_bucket(c: Column, bounds: list[tuple[str, object]], rest: str | None = "p_future") -> Column:
    """Label of the first (label, upper bound) whose bound, exclusive, lies above c; ``rest`` beyond the last.

    NULL sorts below every bound, as in a range-partitioned table.
    """
    out = F.when(c.isNull(), bounds[0][0])
    for label, upper in bounds:
        out = out.when(c < constant(upper), label)
    return out.otherwise(F.lit(rest))


def year_bucket(ts: Column, first: int, last: int) -> Column:
    """One label per year first..last; earlier years fall into the first, later ones into p_future."""
    return range_bucket(F.year(ts), [(f"p{y}", y + 1) for y in range(first, last + 1)])


def list_bucket(df: DataFrame, column: str, groups: dict[str, list], name: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows with their group label, rows whose value is in no list)."""
    out = F.lit(None).cast("string")
    for label, values in groups.items():
        out = F.when(F.col(column).isin(*values), label).otherwise(out)
    marked = df.withColumn(name, out)
    return marked.filter(F.col(name).isNotNull()), marked.filter(F.col(name).isNull()).drop(name)


def hash_bucket(c: Column, n: int) -> Column:
    """Integer key modulo n."""
    return F.pmod(c, F.lit(n))


def key_bucket(c: Column, n: int) -> Column:
    """Hash bucket of a key of any type: the first 32 bits of the MD5 digest of its text, which other engines can compute too."""
    number = F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(n)).cast("int")


def write_partitioned(df: DataFrame, path: str, label: str, compact: bool = False) -> None:
    """Write one directory per label.

    Rows go straight from their tasks to the directories. ``compact`` first
    gathers each label into fewer files; adaptive execution then splits a label
    that is too big for one task.
    """
    if compact:
        df = df.hint("rebalance", F.col(label))
    df.write.partitionBy(label).mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, n: int) -> None:
    """Store a table hashed by ``key`` into n buckets; joins and groups on the key then read it without a shuffle."""
    df.write.bucketBy(n, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(table)


def read_years(spark: SparkSession, path: str, ts: str, label: str, first: int, last: int, lo, hi) -> DataFrame:
    """Rows with lo <= ts < hi from a table written with year_bucket(first, last).

    Adds the matching filter on the partition column, so other directories are
    never listed or read.
    """
    top = hi.year if (hi.month, hi.day, hi.hour, hi.minute, hi.second, hi.microsecond) != (1, 1, 0, 0, 0, 0) else hi.year - 1
    years = range(max(lo.year, first), min(top, last) + 1)
    labels = [f"p{y}" for y in years]
    if lo.year < first:
        labels.append(f"p{first}")
    if top > last:
        labels.append("p_future")
    return (spark.read.parquet(path).filter(F.col(label).isin(*sorted(set(labels))))
            .filter((F.col(ts) >= constant(lo)) & (F.col(ts) < constant(hi))))


def split_archive(df: DataFrame, ts: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows older than the cutoff)."""
    old = F.col(ts) < constant(cutoff)
    return df.filter(~F.coalesce(old, F.lit(False))), df.filter(old)


def partition_counts(df: DataFrame, label: Column, name: str = "label") -> DataFrame:
    return df.groupBy(label.alias(name)).agg(F.count("*").alias("row_count"))


def stored_sizes(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Files and bytes per partition directory, from file metadata."""
    files = spark.read.parquet(path).select(label, "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy(label).agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))


def directory_shard(df: DataFrame, key: str, directory: DataFrame, default: str) -> DataFrame:
    """Shard from a lookup table with columns (key, shard); unknown keys go to ``default``."""
    return skew_join(df, directory, [key], "left").withColumn("shard", F.coalesce("shard", F.lit(default)))


def scatter_gather(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Count, sum and mean per key over all shards; the mean is total over count, never a mean of means.

    Every task first sums its own rows (Spark's partial aggregation), which is the scatter; one shuffle of the partial sums gathers them.
    """
    sums = df.withColumn("_v", value).groupBy(*keys).agg(F.count("_v").alias("cnt"), F.sum("_v").cast("double").alias("total"))
    return sums.withColumn("mean", F.col("total") / F.nullif(F.col("cnt"), F.lit(0)))


def shard_skew(df: DataFrame, shard: Column) -> DataFrame:
    """Shards in use, rows in the largest, and its ratio to the mean."""
    sizes = df.groupBy(shard.alias("_s")).agg(F.count("*").alias("_n"))
    return sizes.agg(F.count("*").alias("shards"), F.max("_n").alias("largest"),
                     (F.max("_n") * F.count("*") / F.sum("_n")).alias("skew"))
