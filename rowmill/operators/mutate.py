"""Table changes as DataFrame rewrites: each takes the current rows and returns the new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.joins import skew_join
from rowmill.operators.ordered import flipped, number_rows, sort_keys, top_rows


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows, allowMissingColumns=True)


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return top_rows(rows, keys, order, 1, "_rn").drop("_rn")


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add rows whose key is new; of equal keys in the batch the first by ``order`` counts."""
    fresh = first_per_key(rows, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], update: list[str],
           order: list[str] | None = None) -> DataFrame:
    """Insert new keys and overwrite the ``update`` columns of known ones; other columns keep their value.

    A left join with the batch and an anti join for its new keys, which can be broadcast or split where a full outer join cannot;
    ``sources.versioned`` does the same to a stored table and rewrites only the partitions that the batch hits.

    With ``order`` the batch may repeat keys: a new key is inserted from its
    first row and updated from its last. Without it keys must be unique.
    """
    if order:
        last = first_per_key(rows, keys, flipped(order)).select(*keys, *[F.col(c).alias(f"_u_{c}") for c in update])
        rows = first_per_key(rows, keys, order).join(last, keys)
        rows = rows.withColumns({c: F.col(f"_u_{c}") for c in update}).drop(*[f"_u_{c}" for c in update])
    values = [c for c in target.columns if c not in keys]
    new = rows.select(*keys, *values).join(target.select(*keys), keys, "left_anti")
    src = rows.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in update], F.lit(True).alias("_src"))
    known = skew_join(target, src, keys, "left")
    known = known.select(*[F.when(F.col("_src"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in target.columns])
    return known.unionByName(new)


def upsert_add(target: DataFrame, rows: DataFrame, keys: list[str], counter: str) -> DataFrame:
    """Add the counters of equal keys; correct for repeated keys in the batch too.

    Other columns of the target stay: those of its row for the key, or of one
    batch row (the least) for a new key; NULL where the batch lacks them.
    """
    rest = [c for c in target.columns if c not in [*keys, counter]]
    have = [c for c in rest if c in rows.columns]
    both = target.withColumn("_new", F.lit(False)).unionByName(
        rows.select(*keys, counter, *have).withColumn("_new", F.lit(True)), allowMissingColumns=True)
    kept = [F.min(F.struct("_new", *rest)).alias("_row")] if rest else []
    added = both.groupBy(*keys).agg(F.sum(counter).alias(counter), *kept)
    return added.select(*[F.col(f"_row.{c}") if c in rest else F.col(c) for c in target.columns])


def update(df: DataFrame, assign: dict[str, Column], where: Column) -> DataFrame:
    """Set columns where the predicate is TRUE; right sides see the old values."""
    return df.select(*[F.when(where, assign[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in assign
                       else F.col(c) for c in df.columns])


def update_in(df: DataFrame, assign: dict[str, Column], key: str, keys: DataFrame) -> DataFrame:
    """Set columns where ``key`` is in the one-column frame ``keys``."""
    hits = keys.toDF(key).distinct().withColumn("_hit", F.lit(True))
    return update(skew_join(df, hits, [key], "left"), assign, F.col("_hit")).drop("_hit")


def update_joined(df: DataFrame, other: DataFrame, keys: list[str], assign: dict[str, Column], where: Column) -> DataFrame:
    """Set columns from a joined frame with unique keys; unmatched rows stay as they are."""
    extra = [c for c in other.columns if c not in keys]
    joined = skew_join(df, other.withColumn("_hit", F.lit(True)), keys, "left")
    return update(joined, assign, F.col("_hit") & where).drop("_hit", *extra)


def update_view(df: DataFrame, view: Column, assign: dict[str, Column], where: Column) -> DataFrame:
    """Update through a filtered view: only rows the view shows can change."""
    return update(df, assign, view & where)


def delete(df: DataFrame, where: Column) -> DataFrame:
    """Drop rows where the predicate is TRUE; rows where it is NULL stay."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def delete_first(df: DataFrame, where: Column, order: list[str], n: int, key: str) -> DataFrame:
    """Drop the first n matching rows; ``key`` identifies a row."""
    victims = df.filter(where).orderBy(*sort_keys(order)).limit(n).select(key)
    return df.join(victims, key, "left_anti")


def keep_lowest(df: DataFrame, key: str, ident: str) -> DataFrame:
    """Of rows with equal ``key`` keep the one with the lowest ``ident``; rows with a NULL key all stay.

    Joining on (key, id) instead of key spreads a key with very many copies.
    """
    lowest = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(ident).alias(ident))
    return df.join(lowest, [key, ident], "left_semi").unionByName(df.filter(F.col(key).isNull()))


def assign_ids(df: DataFrame, order: list[str], name: str = "id", start: int = 1, step: int = 1) -> DataFrame:
    """Dense surrogate keys start, start + step, ... in the given unique order."""
    out = number_rows(df, [], order, name)
    return out.withColumn(name, (F.lit(start) + (F.col(name) - 1) * step).cast("bigint"))


def touch(df: DataFrame, changed: Column, as_of: Column, column: str = "updated_at") -> DataFrame:
    """Stamp changed rows."""
    return df.withColumn(column, F.when(changed, as_of).otherwise(F.col(column)))


def with_defaults(df: DataFrame, schema: str, defaults: dict[str, Column]) -> DataFrame:
    """Rows in the declared schema; omitted columns take their default, given NULLs stay NULL."""
    declared = df.sparkSession.createDataFrame([], schema).schema
    given = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in given else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
                       for f in declared])


def add_column(df: DataFrame, name: str, kind: str, after: str | None = None) -> DataFrame:
    cols = df.columns
    at = cols.index(after) + 1 if after else len(cols)
    new = F.lit(None).cast(kind).alias(name)
    return df.select(*cols[:at], new, *cols[at:])


def widen_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast(kind))


def backfill(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Fill NULLs before a column is declared NOT NULL."""
    return df.withColumn(name, F.coalesce(F.col(name), value))
