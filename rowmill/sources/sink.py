"""Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def truncate(spark: SparkSession, path: str, partition: str | None = None) -> None:
    """Empty a table, or one partition directory such as 'label=p2024', keeping the schema."""
    schema = spark.read.parquet(path).schema
    if partition:
        column = partition.split("=")[0]
        schema = spark.createDataFrame([], schema).drop(column).schema
        path = f"{path}/{partition}"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Read files written under old and new schemas; missing columns are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)
