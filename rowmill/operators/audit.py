"""Audit trails from two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowmill.functions.scalar import json_row


def changes(old: DataFrame, new: DataFrame, key: str, columns: list[str], table: str) -> DataFrame:
    """One row per inserted, updated or deleted key, with the old and new values as JSON. Keys must be unique."""
    a = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in columns], F.lit(True).alias("_old"))
    b = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_new"))
    both = a.join(b, key, "full")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))
    action = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").when(~same, "UPDATE")
    before = F.when(F.col("_old"), json_row(*[F.col(f"_o_{c}").alias(c) for c in columns]))
    after = F.when(F.col("_new"), json_row(*[F.col(f"_n_{c}").alias(c) for c in columns]))
    out = both.select(F.lit(table).alias("table_name"), F.col(key).alias("record_id"), action.alias("action"),
                      before.alias("old_values"), after.alias("new_values"))
    return out.filter(F.col("action").isNotNull())


def judge_raises(current: DataFrame, proposals: DataFrame, key: str, value: str) -> DataFrame:
    """Join proposed values to current ones and mark each: accepted, or why it is refused."""
    both = current.select(key, F.col(value).alias("old_value")).join(proposals.select(key, F.col(value).alias("new_value")), key)
    verdict = F.when(F.col("new_value") < 0, "negative").when(F.col("new_value") > F.col("old_value") * 2, "more than doubled").otherwise("accepted")
    return both.withColumn("verdict", verdict)


def raise_audit(judged: DataFrame) -> DataFrame:
    """Audit rows of accepted changes; an unchanged value leaves none."""
    return judged.filter((F.col("verdict") == "accepted") & (F.col("old_value") != F.col("new_value"))).drop("verdict").withColumn(
        "action", F.lit("SALARY_CHANGE"))
