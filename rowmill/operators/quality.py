"""Constraint checks. Each returns the violating rows or keys; an empty result means the constraint holds."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.joins import skew_join


def _all_set(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def check_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Repeated keys; a key with a NULL part never repeats."""
    return df.filter(_all_set(columns)).groupBy(*columns).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_primary_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that repeat or have a NULL part."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("copies"))
    return groups.filter((F.col("copies") > 1) | ~_all_set(columns))


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(~_all_set(columns))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows without a parent; a NULL reference is allowed."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def check_rule(df: DataFrame, rule: Column) -> DataFrame:
    """Rows where the rule is FALSE; NULL passes."""
    return df.filter(~F.coalesce(rule, F.lit(True)))


def check_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Rows with a value outside the domain; NULL passes."""
    return df.filter(~F.col(column).isin(*allowed))


def delete_cascade(child: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """Children left after their parents in the one-column frame ``gone`` are deleted."""
    return child.join(gone.toDF(column), column, "left_anti")


def delete_set_null(child: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    hits = gone.toDF(column).distinct().withColumn("_gone", F.lit(True))
    return skew_join(child, hits, [column], "left").withColumn(
        column, F.when(F.col("_gone"), None).otherwise(F.col(column))).drop("_gone").select(*child.columns)


def delete_restrict(child: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """Children that forbid the delete."""
    return child.join(gone.toDF(column), column, "left_semi")


def update_cascade(child: DataFrame, column: str, renamed: DataFrame) -> DataFrame:
    """Follow changed parent keys, given as (old, new) with unique old keys."""
    moves = renamed.toDF(column, "_new").withColumn("_moved", F.lit(True))
    out = skew_join(child, moves, [column], "left")
    return out.withColumn(column, F.when(F.col("_moved"), F.col("_new")).otherwise(F.col(column))).select(*child.columns)


def check_dependency(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Left values that do not determine the right values. Copies fall away first, so a hot value is no burden."""
    pairs = df.select(*left, *right).distinct().groupBy(*left).agg(F.count("*").alias("variants"))
    return pairs.filter("variants > 1").select(*left)


def repeats(df: DataFrame, columns: tuple[str, ...]) -> bool:
    """Do two rows agree in these columns; one grouping."""
    return not df.groupBy(*columns).count().filter("count > 1").isEmpty()


def column_keys(df: DataFrame, columns: list[str], width: int = 2, deviation: float = 0.02) -> DataFrame:
    """Every set of up to ``width`` columns: is it a superkey, and is it a minimal (candidate) key.

    Sets go by width. One that holds a known key is a superkey without a look at the rows. One pass sketches the distinct values of all other sets of a width;
    those that stay six relative deviations below the number of rows hold repeats (a sketch errs that far once in some 10^9 sets), and only the
    rest are grouped to be sure.
    """
    keys: list[set[str]] = []
    found = []
    for w in range(1, width + 1):
        sets = list(combinations(columns, w))
        unsure = [s for s in sets if not any(k <= set(s) for k in keys)]
        sketches = [F.approx_count_distinct(F.xxhash64(*[F.struct(F.col(c)) for c in s]), deviation) for s in unsure]
        rows, *rough = df.agg(F.count(F.lit(1)), *sketches).first() if unsure else (0,)
        near = [s for s, n in zip(unsure, rough) if n >= rows * (1 - 6 * deviation)]
        fresh = [set(s) for s in near if not repeats(df, s)]
        found += [(",".join(s), set(s) in fresh or s not in unsure, set(s) in fresh) for s in sets]
        keys += fresh
    return df.sparkSession.createDataFrame(found, "columns string, is_superkey boolean, is_candidate boolean")


def normal_form_violations(df: DataFrame, rules: list[tuple[list[str], list[str]]]) -> DataFrame:
    """Rules X -> Y that hold although X is not a key (Boyce-Codd violations), one row per rule."""
    out = None
    for left, right in rules:
        broken = check_dependency(df, left, right).limit(1).agg((F.count("*") > 0).alias("broken"))
        repeated = df.groupBy(*left).count().filter("count > 1").limit(1).agg(F.count("*") > 0).scalar()
        row = broken.select(F.lit(",".join(left)).alias("determinant"), F.lit(",".join(right)).alias("dependent"),
                            (~F.col("broken")).alias("holds"), (~F.col("broken") & repeated).alias("violates"))
        out = row if out is None else out.unionByName(row)
    return out


def same_total(before: DataFrame, after: DataFrame, value: Column) -> DataFrame:
    """One row: both totals and whether they agree."""
    total = after.agg(F.sum(value).cast("double")).scalar()
    return before.agg(F.sum(value).cast("double").alias("before")).withColumn("after", total).withColumn(
        "balanced", F.col("before") == F.col("after"))
