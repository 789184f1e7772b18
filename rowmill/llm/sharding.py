"""Weighted rendezvous sharding by a stable record key. Native: DataFrame functions only.

Every (key, shard) pair has a pseudo-random number u in (0, 1); a record goes to the shard with the least -ln(u) / weight.
A new shard wins some records from the others and moves no record between them; a changed weight moves records only
into or out of its own shard.

Defined cases: a null key hashes as the empty text, so all such rows share a shard; a null text has size 1 and crc32 0; equal
rows get the slots of their group in any order, which makes no difference; an empty table gives no rows; columns
besides the named ones are kept by ``assign`` and ignored by ``numbered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowmill.llm.common import fresh, query, table

SHARDS = 8
#: Slices of each shard for numbering; a slice holds 1 / (shards * SLICES) of the distinct rows.
SLICES = 4096


def _uniform(key: Column, shard: int) -> Column:
    """In (0, 1): the first 52 bits of an MD5 digest."""
    digits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (digits.cast("double") + 0.5) / F.lit(float(2**52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard 0..n-1 of a key under these weights; ties go to the lower number, a weight of 0 gets nothing."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [F.struct((-F.ln(_uniform(text, s)) / F.lit(float(w))).alias("cost"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*scores))["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], into: str = "shard") -> DataFrame:
    """``df`` with its shard in column ``into``: one projection, no shuffle."""
    return df.withColumn(into, rendezvous(F.col(key), weights))


def numbered(df: DataFrame, shard: str, slot: str = "slot") -> DataFrame:
    """Rows with a gapless number from 0 within their shard, in the order of (slice, all columns).

    Equal rows are counted first, so a repeated row costs one row in the shuffles. Each shard is cut into slices by
    the hash of all columns, which also deals the rows of one very common key: a running count inside a slice, plus the rows of the slices before it (at most shards * SLICES sums, broadcast).
    """
    columns = df.columns
    at, n, rows, start, inside, first, into, slot_at = fresh(columns, "_slice", "_n", "_rows", "_start", "_inside", "_shard", slot, "_at")
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    slices = F.conv(F.substring(F.md5(text.cast("binary")), 1, 3), 16, 10).cast("int")
    counted = df.withColumn(at, slices).groupBy(at, *columns).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(shard).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.groupBy(shard, at).agg(F.sum(n).alias(rows))
    starts = starts.select(F.col(shard).alias(first), F.col(at).alias(slot_at), F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(start))
    own = Window.partitionBy(shard, at).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn(inside, F.coalesce(F.sum(n).over(own), F.lit(0)))
    placed = placed.join(F.broadcast(starts), (F.col(shard) == F.col(first)) & (F.col(at) == F.col(slot_at)))
    number = F.col(start) + F.col(inside)
    return placed.select(*columns, F.explode(F.sequence(number, number + F.col(n) - 1)).alias(into))


def _sql_cost(shard: int) -> str:
    return (f"-ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{shard}'), 1, 13) AS BIGINT)::DOUBLE + 0.5) "
            f"/ 4503599627370496.0)")


def _sql_shard(count: int) -> str:
    costs = ", ".join(_sql_cost(s) for s in range(count))
    return f"(list_position([{costs}], least({costs})) - 1)::INT"


# CRC-32 in SQL: the table of the reflected polynomial EDB88320, then one step for each byte.
ORACLE = f"""
WITH bits AS (
  SELECT list(list_reduce([i] || range(8)::BIGINT[], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
bytes AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT) AS b FROM documents),
sized AS (
  SELECT doc_id, size, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
    {_sql_shard(SHARDS)} AS shard, {_sql_shard(SHARDS + 1)} AS grown_shard
  FROM bytes, bits),
sliced AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32, shard, grown_shard)), 1, 3))::INT AS slice
  FROM sized)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM sliced
"""


@query("op3_sharding", ORACLE)
def sharded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by doc_id, the key law."""
    bytes_ = F.col("text").cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(bytes_), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.coalesce(F.crc32(bytes_), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    rows = assign(assign(rows, "doc_id", [1.0] * SHARDS), "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    slots = numbered(rows, "shard")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
