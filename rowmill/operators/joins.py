"""Join forms, including one that spreads hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.session import materialize, plan_bytes, rows_bound, settled

TASK_ROWS = 2_000_000  # rows of one key that one task may take
HOT_SHARE = 1 / 200_000  # a hot key holds more than this share, so there are fewer than 200 000 of them
SMALL_BYTES = 32 << 20  # a table of this estimated size and of TASK_ROWS rows is fair work for one task, so its groups need no check


def is_small(df: DataFrame) -> bool:
    """True if both the estimated bytes and a bound of the rows say so; bytes alone mislead, as stored columns may be packed a thousandfold."""
    size = plan_bytes(df)
    if size is None or size > SMALL_BYTES:
        return False
    rows = rows_bound(df)
    return rows is not None and rows <= TASK_ROWS


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows, rows of the largest group); one aggregation that reads the key columns only."""
    total, largest = df.groupBy(*keys).count().agg(F.sum("count"), F.max("count")).first()
    return total or 0, largest or 0


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Hint a broadcast only when the table proves small."""
    return F.broadcast(df) if is_small(df) else df


def _on(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> tuple[DataFrame, Column]:
    """Rename the right keys and build the join condition."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        a, b = F.col(k), F.col(f"_r_{k}")
        cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
    return right, cond


def equi_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
              null_safe: bool = False) -> DataFrame:
    """Join on equal key names; the result has the left columns and the right non-key columns."""
    if not null_safe:
        return left.join(right, keys, how)
    right, cond = _on(left, right, keys, True)
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
              null_safe: bool = False) -> DataFrame:
    """Equi join (inner, left, left_semi, left_anti) whose hot left keys are spread over many tasks.

    A right side that proves small is broadcast. Otherwise a key is hot above
    both TASK_ROWS and HOT_SHARE of the left rows (the second bounds the table of hot keys); hot left rows get a salt and
    the matching right rows are repeated once per salt. Adaptive execution
    splits skewed scans by itself; this form also covers a right side that is
    an aggregate, where it does not.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    small = is_small(right)
    if not small and not is_small(left):
        right = settled(right)  # its stored size is then known
        small = is_small(right)
        if not small:
            return _salted(left, right, keys, how, null_safe)
    return equi_join(left, F.broadcast(right) if small else right, keys, how, null_safe)


def _salted(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    left = settled(left)
    total, largest = group_sizes(left, keys)
    bound = max(TASK_ROWS, int(total * HOT_SHARE))
    if largest <= bound:
        return equi_join(left, right, keys, how, null_safe)
    hot = materialize(left.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > bound)
                      .select(*keys, F.ceil(F.col("_n") / bound).cast("int").alias("_salts")))
    columns = left.columns
    left = materialize(left).withColumn("_row", F.monotonically_increasing_id())
    left = equi_join(left, F.broadcast(hot), keys, "left", True)
    left = left.withColumn("_salt", F.coalesce(F.pmod(F.col("_row"), F.col("_salts")), F.lit(0)).cast("int"))
    right = equi_join(right, F.broadcast(hot), keys, "left", True)
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
    out = equi_join(left.drop("_row", "_salts"), right.drop("_salts"), keys + ["_salt"], how, null_safe)
    rest = [c for c in out.columns if c not in columns and c != "_salt"]
    return out.select(*columns, *rest)


def attach(df: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of ``facts`` (one row per key, NULL is a key) to every row of ``df``."""
    return skew_join(df, facts, keys, "left", null_safe=True)


def full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join as a left join plus the right rows without a partner.

    A plain full outer join can neither be broadcast nor split on a hot key;
    both halves here can.
    """
    matched = left.join(right, keys, "left")
    lonely = right.join(left.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every combination, as the open cross join it is; the right side is broadcast only if it proves small."""
    return left.crossJoin(bounded_broadcast(right))


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """``column NOT IN (subquery)``: no rows if the list holds a NULL, and a NULL operand passes only an empty list.

    The NULL test is one small query, so the join stays a plain hash anti join
    instead of the null-aware broadcast form, which cannot take a big list.
    """
    values = listed.select(F.col(listed_column).alias(column))
    if values.isEmpty():
        return df
    if not values.filter(F.col(column).isNull()).isEmpty():
        return df.limit(0)
    return df.filter(F.col(column).isNotNull()).join(values, column, "left_anti")
