"""Smallness, deep chains, and rules that must hold whatever the size."""


import itertools
import os
import re

import pytest
from pyspark.sql import functions as F

from rowmill.operators import aggregates, allocation, baskets, hierarchy, joins, mutate, paging, quality
from rowmill.plans import load_catalog
from rowmill.session import materialize, plan_bytes, rows_bound, shared_folder

from rowmill.sources.scan import Tables, literal_rows

SF = "/root/testdata/sf0.001"


def test_small_needs_few_rows_not_only_few_bytes(spark, monkeypatch):
    nation = Tables(spark, SF).nation
    assert plan_bytes(nation) > 0 and rows_bound(nation) == 25 and joins.is_small(nation)
    assert joins.is_small(nation.filter("n_regionkey = 1").groupBy("n_regionkey").count())
    burst = nation.select(F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("x"))
    assert rows_bound(burst) is None and not joins.is_small(burst)
    assert not joins.is_small(nation.crossJoin(nation.select(F.col("n_name").alias("other"))))
    assert joins.is_small(nation.join(nation.select("n_nationkey"), "n_nationkey", "left_semi"))
    packed = materialize(spark.range(50_000).select(F.lit(7).alias("same")))
    assert plan_bytes(packed) < joins.SMALL_BYTES and joins.is_small(packed)
    monkeypatch.setattr(joins, "TASK_ROWS", 40_000)
    assert not joins.is_small(packed)


def test_hinted_join_is_broadcast(spark):
    plan = load_catalog()["jn_24_hint_broadcast"].build(Tables(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_allocation_is_one_result_whatever_the_form(spark, monkeypatch):
    rows = [(i, i % 3, q) for i, q in enumerate([5, None, 0, -2, 7, 3, 3, None, 9, 1, 1, 4] * 20)]
    asked = literal_rows(spark, "id int, product int, qty int", rows)
    stock = literal_rows(spark, "product int, stock int", [(0, 60), (1, 35), (2, 90)])
    one = {r.id: r.accepted for r in allocation.allocate(asked, stock, "product", ["id"], "qty").collect()}
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    many = {r.id: r.accepted for r in allocation.allocate(asked, stock, "product", ["id"], "qty").collect()}
    left, want = {0: 60, 1: 35, 2: 90}, {}
    for i, p, q in rows:
        want[i] = q is not None and 0 < q <= left[p]
        left[p] -= q if want[i] else 0
    assert one == many == want


def test_settling_refuses_inactive_accounts(spark):
    legs = literal_rows(spark, "id int, account int, delta int", [(1, 1, -5), (1, 2, 5), (2, 1, -5), (2, 3, 5), (3, 2, -3), (3, 1, 3)])
    accounts = literal_rows(spark, "account int, balance int, floor int, open boolean", [(1, 9, 0, True), (2, 0, 0, True), (3, 50, 0, False)])
    got = allocation.settle(legs, accounts, "id", ["id"], "balance", "floor", "open").collect()
    assert {r.id: r.accepted for r in got} == {1: True, 2: False, 3: True}


def test_deep_chain_and_cycles(spark):
    n = 20_000
    chain = spark.range(n).select("id", F.nullif(F.col("id"), F.lit(0)).alias("p")).withColumn("p", F.col("p") - 1)
    loose = literal_rows(spark, "id bigint, p bigint", [(n + 1, n + 2), (n + 2, n + 1), (n + 3, n + 1), (n + 4, -9)])
    folder = shared_folder(spark)
    before = len(os.listdir(folder))
    depth = hierarchy.from_roots(chain.unionByName(loose), "id", "p", {"depth": F.col("p").isNotNull().cast("int")}, {"depth": lambda up, low: up + low})
    assert depth.agg(F.count("*"), F.max("depth"), F.count_if(F.col("depth") != F.col("id"))).first()[:] == (n, n - 1, 0)
    assert len(os.listdir(folder)) == before + 1


def test_added_counters_keep_other_columns(spark):
    target = literal_rows(spark, "k int, n bigint, note string", [(1, 5, "old"), (2, 1, None)])
    batch = literal_rows(spark, "k int, n bigint, note string", [(1, 2, "new"), (3, 4, "b"), (3, 1, "a")])
    assert sorted(map(tuple, mutate.upsert_add(target, batch, ["k"], "n").collect())) == [(1, 7, "old"), (2, 1, None), (3, 5, "a")]
    assert sorted(map(tuple, mutate.upsert_add(target, batch.drop("note"), ["k"], "n").collect())) == [(1, 7, "old"), (2, 1, None), (3, 5, None)]


def test_joined_text_is_one_row_whatever_the_line(spark):
    df = spark.range(2500).select(F.col("id"), (F.col("id") % 2).alias("g"))
    got = {r.g: r.listing for r in aggregates.joined_text(df, ["g"], "id", ["id"], per_line=100).collect()}
    assert got == {g: ", ".join(str(i) for i in range(g, 2500, 2)) for g in (0, 1)}


@pytest.mark.parametrize("n", [1, 3, 4, 10, 25])
def test_tile_of(spark, n):
    rows = spark.range(1, n + 1).select("id", paging.tile_of(F.col("id"), F.lit(n), 4).alias("t"), F.expr("ntile(4) OVER (ORDER BY id)").alias("w"))
    assert rows.where("t <> w").count() == 0


def test_ancestors_of_a_deep_chain_take_few_joins(spark, monkeypatch):
    n = 20_000
    chain = spark.range(n).select("id", (F.nullif(F.col("id"), F.lit(0)) - 1).alias("p"), F.concat(F.lit("n"), "id").alias("name"))
    made, real = [], hierarchy.skew_join
    monkeypatch.setattr(hierarchy, "skew_join", lambda *a: made.append(a) or real(*a))
    starts = literal_rows(spark, "s bigint", [(n - 1,), (5,), (-3,)])
    folder = shared_folder(spark)
    before = len(os.listdir(folder))
    up = hierarchy.ancestors(chain, "id", "p", starts)
    assert len(made) + 1 <= 16 and len(os.listdir(folder)) == before + 1
    want = (n + 6, n - 1, 0)
    assert up.agg(F.count("*"), F.max("depth"), F.count_if(F.col("depth") != F.col("start") - F.col("id"))).first()[:] == want
    loop = chain.unionByName(literal_rows(spark, "id bigint, p bigint, name string", [(n + 1, n + 2, "a"), (n + 2, n + 1, "b")]))
    assert hierarchy.ancestors(loop, "id", "p", starts).count() == n + 6
    with pytest.raises(ValueError):
        hierarchy.ancestors(loop, "id", "p", literal_rows(spark, "s bigint", [(n + 2,)]))


def test_items_of_one_huge_basket_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(baskets, "BLOCK_ITEMS", 50)
    counts = spark.range(1200).selectExpr("if(id < 400, 0, id div 4) as basket", "if(id < 400, id, id % 4) as item", "1 + id % 3 as m")
    rows = baskets.blocked(counts)
    assert rows.groupBy("basket", "block").count().agg(F.max("count")).first()[0] == 50
    keys = rows.select("basket", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("x"), "block").groupBy("basket", "block", "x").count()
    assert keys.agg(F.max("count"), F.max("x")).first()[:] == (50, 7)
    got = baskets.line_pairs(counts)
    a, b = counts.toDF("basket", "item_a", "m_a"), counts.toDF("basket", "item_b", "m_b")
    want = a.join(b, "basket").filter("item_a < item_b").drop("basket")
    assert got.count() == want.count() == 400 * 399 // 2 + 200 * 6 and got.exceptAll(want).isEmpty()


def test_one_hot_product_leaves_the_others_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    rounds, real = [], allocation._allocate_by_rounds
    monkeypatch.setattr(allocation, "_allocate_by_rounds", lambda rows, *a: rounds.append({r.p for r in rows.select("p").distinct().collect()}) or real(rows, *a))
    asked = spark.range(900).selectExpr("if(id % 3 = 0, 1, 2 + id % 20) as p", "id as seq", "1 + id * 7 % 11 as q")
    stock = literal_rows(spark, "p bigint, stock int", [(1, 200), *((p, 60) for p in range(2, 15))])
    folder = shared_folder(spark)
    got = {r.seq: r.accepted for r in allocation.allocate(asked, stock, "p", ["seq"], "q").collect()}
    left, want = {1: 200, **{p: 60 for p in range(2, 15)}}, {}
    for r in asked.orderBy("seq").collect():
        want[r.seq] = left.get(r.p, 0) >= r.q
        left[r.p] = left.get(r.p, 0) - (r.q if want[r.seq] else 0)
    assert got == want and rounds == [{1}] and folder


def test_each_round_of_versioned_updates_reads_its_own_requests(spark, monkeypatch):
    read, real = [], allocation.requests_of_round

    def watched(wanted, step):
        rows = real(wanted, step)
        read.append((step, rows._jdf.queryExecution().executedPlan().toString()))
        return rows

    monkeypatch.setattr(allocation, "requests_of_round", watched)
    asked = spark.range(4000).selectExpr("id % 10 as p", "id as pos", "1 as q", "5 + id % 7 as version")
    stock = spark.range(10).selectExpr("id as p", "1000 as stock", "5 as version")
    folder = shared_folder(spark)
    before = len(os.listdir(folder))
    after, applied = allocation.apply_versioned(stock, asked, "p", "pos", "q")
    assert {r.version for r in after.collect()} == {12} and applied.count() == 70
    assert len(read) == 8 and len(os.listdir(folder)) == before + 2
    for step, plan in read:
        assert re.search(rf"PartitionFilters: [^\n]*\(_step#\d+L? = {step}\)", plan), plan


def test_rough_count_reads_footers_of_some_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(60_000).select("id", F.rand(1).alias("x")).repartition(40, "id").write.parquet(path)
    table = spark.read.parquet(path)
    rough, margin = aggregates.rough_count(table)
    assert (rough, margin) == (60_000, 0)
    asked, real = [], aggregates.footer_rows
    try:
        aggregates.footer_rows = lambda spark, files: asked.append(files) or real(spark, files)
        rough, margin = aggregates.rough_count(table, files=10)
    finally:
        aggregates.footer_rows = real
    assert len(asked[0]) == 10 and 0 < margin < 6_000 and abs(rough - 60_000) <= margin
    plan = real(spark, asked[0])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "10 paths" in plan
    assert aggregates.rough_count(spark.range(7)) == (7, 0)


def test_candidate_keys_group_few_sets_exactly(spark, monkeypatch):
    made = []
    real = quality.repeats
    monkeypatch.setattr(quality, "repeats", lambda df, s: made.append(s) or real(df, s))
    df = spark.range(6000).selectExpr("id div 60 as a", "id % 60 as b", "id % 7 as c", "id div 2000 as d", "1 as e", "nullif(id % 3, 0) as f")
    got = {r.columns: (r.is_superkey, r.is_candidate) for r in quality.column_keys(df, list("abcdef"), 3).collect()}
    for w in (1, 2, 3):
        for s in itertools.combinations("abcdef", w):
            sup = df.select(*s).distinct().count() == 6000
            smaller = any(got[",".join(x)][0] for k in range(1, w) for x in itertools.combinations(s, k))
            assert got[",".join(s)] == (sup, sup and not smaller), s
    assert got["a,b"] == (True, True) and len(made) < 12 < len(got)
    empty = {r.columns: r.is_superkey for r in quality.column_keys(df.limit(0), ["a", "b"], 2).collect()}
    assert empty == {"a": True, "b": True, "a,b": True}


def test_fraud_alerts_scan_orders_twice(spark):
    plan = load_catalog()["ap_16_fraud_alerts"].build(Tables(spark, SF))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    # The clock's scan is printed wherever its one result is used again.
    assert len(set(re.findall(r"FileScan parquet .*ReadSchema: (\S+)", text))) == 2 and "Union" not in text and "ReusedSubquery" in text


def test_sums_move_in_as_many_tasks_as_asked_and_a_frequent_key_as_few_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(7 if i % 3 else i, None if i % 5 == 0 else 1, 1) for i in range(3000)], "a long, b long, m long")
    got = baskets.summed(rows, ["a", "b"], "m", 37)
    want = {}
    for a, b, m in rows.collect():
        want[a, b] = want.get((a, b), 0) + m
    assert {(r.a, r.b): r.m for r in got.collect()} == want and got.rdd.getNumPartitions() == 37
    monkeypatch.setattr(baskets, "TASK_PAIRS", 20)
    asked = []
    made = baskets.summed
    monkeypatch.setattr(baskets, "summed", lambda rows, keys, value, tasks: asked.append(tasks) or made(rows, keys, value, tasks))
    lines = spark.createDataFrame([(b, i) for b in range(40) for i in range(b % 5, b % 5 + 6)], "b long, i long")
    best = baskets.frequent_pairs(lines, "b", "i", 2, 3)
    assert asked[-1] == 30  # 40 baskets of 15 pairs, 20 a task
    assert [(r.item_a, r.item_b, r.together) for r in best.collect()] == [(4, 5, 40), (3, 4, 32), (3, 5, 32)]
