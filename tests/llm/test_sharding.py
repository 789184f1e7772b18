import hashlib
import math
import zlib

from pyspark.sql import functions as F

from rowmill.llm import sharding

from helpers import documents, odd_texts, save


def shard_of(key, count):
    def cost(s):
        h = int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16)
        return -math.log((h + 0.5) / 2**52)

    return min(range(count), key=cost)


def test_op3_matches_brute_force(spark, tmp_path):
    texts = odd_texts()
    ids = [*range(len(texts) - 3), 5, None, None]
    save(documents(spark, texts * 2, ids * 2), tmp_path, "documents")
    rows = sharding.sharded_documents(spark, str(tmp_path)).collect()
    got = sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows)
    assert got == sorted((str(i), 1 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in zip(ids * 2, texts * 2))
    for r in rows:
        key = "" if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard, r.law) == (shard_of(key, 8), shard_of(key, 9), "key")
        assert r.grown_shard in (r.shard, 8)
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_weights_share_the_rows_and_move_few(spark):
    df = spark.range(20_000).withColumn("_slice", F.lit(1)).withColumn("_n", F.lit(2))
    a = sharding.assign(df, "id", [1, 1, 2, 0])
    counts = {r.shard: r["count"] for r in a.groupBy("shard").count().collect()}
    assert 3 not in counts and abs(counts[2] - 10_000) < 400
    b = sharding.assign(a, "id", [1, 1, 2, 1], "later")
    assert b.where("later <> shard and later <> 3").count() == 0
    numbered = sharding.numbered(a, "shard")
    assert numbered.columns == [*a.columns, "slot"] and numbered.count() == 20_000
    assert numbered.groupBy("shard").agg(F.countDistinct("slot").alias("n"), F.max("slot").alias("m")).where("n <> m + 1").count() == 0


def test_many_rows_without_a_key_share_the_slices(spark, tmp_path):
    """All of them go to one shard; its slots are still numbered in many slices, none with more than a small part."""
    n = 100_000
    rows = spark.range(n).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("").alias("lang"), F.lit("").alias("source"), F.lit(0).cast("bigint").alias("n_chars"))
    save(rows, tmp_path, "documents")
    got = sharding.sharded_documents(spark, str(tmp_path))
    assert got.agg(F.count("*"), F.countDistinct("slot"), F.max("slot"), F.countDistinct("shard")).first()[:] == (n, n, n - 1, 1)
    text = F.concat_ws(":", F.lit(""), "size", "text_crc32", "shard", "grown_shard")
    slices = got.groupBy(F.substring(F.md5(text.cast("binary")), 1, 3)).count().agg(F.max("count"), F.count("*")).first()
    assert slices[0] < 80 and slices[1] == 4096


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert sharding.sharded_documents(spark, str(tmp_path)).count() == 0


def test_plan_is_native(spark):
    plan = sharding.sharded_documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
