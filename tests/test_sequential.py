"""Allocation, versioned updates and settlement against plain sequential replays, in both forms."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rowmill.operators import allocation, components, joins
from rowmill.session import shared_folder


def replay_allocation(stock, requests):
    left, out = dict(stock), []
    for p, seq, q in sorted(requests, key=lambda r: r[1]):
        ok = left.get(p, 0) >= q
        if ok:
            left[p] -= q
        out.append((p, seq, q, ok))
    return sorted(out)


@pytest.fixture(scope="module")
def asks():
    rng = random.Random(5)
    # Product 1 takes two thirds of the requests.
    stock = [(p, rng.randint(20, 400)) for p in range(1, 8)]
    requests = [(1 if rng.random() < 0.66 else rng.randint(1, 8), i, rng.randint(1, 30)) for i in range(400)]
    return stock, requests


@pytest.mark.parametrize("big", [False, True])
def test_allocation(spark, asks, big, request):
    if big:
        request.getfixturevalue("small_tasks")
    stock, requests = asks
    got = allocation.allocate(spark.createDataFrame(requests, "p int, seq int, q int"), spark.createDataFrame(stock, "p int, stock int"),
                              "p", ["seq"], "q")
    assert sorted(map(tuple, got.collect())) == replay_allocation(stock, requests)
    after = {r.p: r.stock for r in allocation.stock_after(spark.createDataFrame(stock, "p int, stock int"), got, "p", "q").collect()}
    assert all(v >= 0 for v in after.values())


def test_small_fold(spark):
    out = allocation.allocate(spark.createDataFrame([(1, 1, 5), (1, 2, 10), (1, 3, 3)], "p int, seq int, q int"),
                              spark.createDataFrame([(1, 9)], "p int, stock int"), "p", ["seq"], "q")
    assert [r.accepted for r in out.orderBy("seq").collect()] == [True, False, True]


def test_versioned(spark):
    rng = random.Random(3)
    stock = [(p, rng.randint(10, 60), 0) for p in range(6)]
    asks = [(rng.randint(0, 6), i, rng.randint(1, 25), rng.randint(0, 3)) for i in range(200)]
    state, applied = {p: [s, v] for p, s, v in stock}, []
    for p, pos, q, v in asks:
        if p in state and state[p][1] == v and state[p][0] >= q:
            state[p][0] -= q
            state[p][1] += 1
            applied.append((p, pos))
    after, done = allocation.apply_versioned(spark.createDataFrame(stock, "p int, stock int, version int"),
                                             spark.createDataFrame(asks, "p int, pos int, q int, version int"), "p", "pos", "q")
    assert sorted((r.p, r.stock, r.version) for r in after.collect()) == sorted((p, s, v) for p, (s, v) in state.items())
    assert sorted((r.p, r.pos) for r in done.collect()) == sorted(applied)


def replay_transfers(balances, transfers, floor):
    held, out = dict(balances), {}
    for i, (a, b, m) in enumerate(transfers):
        ok = a in held and b in held and held[a] - m >= floor
        if ok:
            held[a] -= m
            held[b] += m
        out[i] = ok
    return held, out


@pytest.mark.parametrize("seed,big", [(1, False), (2, False), (1, True)])
def test_settlement(spark, big, seed, request):
    if big:
        request.getfixturevalue("small_tasks")
    rng = random.Random(seed)
    balances = {a: rng.randint(0, 300) for a in range(12)}
    # Account 0 is a side of half of the transfers; account 99 does not exist.
    pick = lambda: 0 if rng.random() < 0.3 else rng.choice([*range(12), 99])
    transfers = [(pick(), pick(), rng.randint(1, 200)) for _ in range(160)]
    held, want = replay_transfers(balances, transfers, -50)
    df = spark.createDataFrame([(i, a, b, m) for i, (a, b, m) in enumerate(transfers)], "id long, a long, b long, m long")
    accounts = spark.createDataFrame([(a, v, -50) for a, v in balances.items()], "account long, balance long, floor long")
    legs = allocation.transfer_legs(df, "a", "b", "m")
    got = {r.id: r.accepted for r in allocation.settle(legs, accounts, "id", ["id"], "balance", "floor").collect()}
    assert got == want
    moved = legs.join(spark.createDataFrame([(k,) for k, v in got.items() if v], "id long"), "id").groupBy("account").sum("delta").collect()
    after = {a: v for a, v in balances.items()}
    for r in moved:
        after[r.account] += r["sum(delta)"]
    assert after == held and sum(after.values()) == sum(balances.values())


def test_transfer_example(spark):
    accounts = spark.createDataFrame([(1, 10000, 0), (2, 5000, 0), (3, 8000, 0)], "account long, balance long, floor long")
    legs = allocation.transfer_legs(spark.createDataFrame([(1, 1, 2, 1500)], "id long, a long, b long, m long"), "a", "b", "m")
    posted = allocation.post_unchecked(legs, accounts, ["id", "type"], "balance", F.col("floor"))
    assert sorted((r.account, r.balance_after, r.overdrawn) for r in posted.collect()) == [(1, 8500, False), (2, 6500, False)]


def test_all_or_nothing_pair(spark):
    stock = spark.createDataFrame([(1, 5, 0), (2, 1, 0)], "account long, stock long, floor long")
    legs = spark.createDataFrame([(1, 1, -3), (1, 2, -2), (2, 1, -4), (2, 2, -1)], "id long, account long, delta long")
    got = {r.id: r.accepted for r in allocation.settle(legs, stock, "id", ["id"], "stock", "floor").collect()}
    assert got == {1: False, 2: True}


def test_pair_reservation_holds_all_lines(spark, tmp_path):
    from rowmill.plans import load_catalog
    from rowmill.plans.registry import runner

    rng = random.Random(11)
    lines = [(o, n, rng.randint(1, 9), float(rng.randint(1, 40))) for o in range(120) for n in range(1, rng.randint(2, 8))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, f"part {p}") for p in range(1, 9)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    left, want = {p: p * 37 % 101 * 4 for p in range(1, 9)}, {}
    for o in sorted({line[0] for line in lines}):
        need = {}
        for order, _, p, q in lines:
            if order == o:
                need[p] = need.get(p, 0) + int(q)
        want[o] = all(left.get(p, -1) >= q for p, q in need.items())
        if want[o]:
            for p, q in need.items():
                left[p] -= q
    assert any(len([x for x in lines if x[0] == o]) > 2 for o, ok in want.items() if ok)
    got = {r.order_id: r.accepted for r in runner(load_catalog()["ap_10_pair_reservation"])(spark, str(tmp_path)).collect()}
    assert got == want


def settled(spark, transfers, balances, floor, trace):
    df = spark.createDataFrame([(i, a, b, m) for i, (a, b, m) in enumerate(transfers)], "id long, a long, b long, m long")
    accounts = spark.createDataFrame([(a, v, floor) for a, v in balances.items()], "account long, balance long, floor long")
    legs = allocation.transfer_legs(df, "a", "b", "m")
    return {r.id: r.accepted for r in allocation.settle(legs, accounts, "id", ["id"], "balance", "floor", trace=trace).collect()}


def test_a_chain_where_each_request_needs_the_one_before_takes_few_rounds(spark, monkeypatch):
    """Every account passes on what it just received; every seventh sends too much, after which the next has nothing to send."""
    balances = {a: 10 if a % 50 == 0 else 0 for a in range(601)}
    transfers = [(i, i + 1, 99 if i % 7 == 6 else 10) for i in range(600)]
    want, trace = replay_transfers(balances, transfers, 0)[1], []
    assert settled(spark, transfers, balances, 0, trace) == want and [k for k, _ in trace] == ["bracket", "fold"]
    monkeypatch.setattr(allocation, "FOLD_ROWS", 10)
    trace = []
    assert settled(spark, transfers, balances, 0, trace) == want
    assert len(trace) <= 3 and "components" in {k for k, _ in trace}
    # A component larger than a task: its first requests are judged, round by round, 300 legs at a time.
    monkeypatch.setattr(joins, "TASK_ROWS", 300)
    trace = []
    assert settled(spark, transfers, balances, 0, trace) == want
    assert len(trace) <= 9


def test_rounds_that_settle_a_third_are_followed_by_brackets_of_what_can_still_be_felt(spark, monkeypatch):
    """All lines or none on scarce stock: the first bracket leaves more than half of the legs open, yet no component is sought."""
    monkeypatch.setattr(allocation, "FOLD_ROWS", 1000)  # a second bracket is needed
    rng = random.Random(4)
    stock = {p: rng.randint(0, 400) for p in range(60)}
    wants = {o: {p: rng.randint(1, 50) for p in rng.sample(range(62), rng.randint(1, 6))} for o in range(500)}
    left, want = dict(stock), {}
    for o, need in wants.items():
        want[o] = all(left.get(p, -1) >= q for p, q in need.items())
        if want[o]:
            for p, q in need.items():
                left[p] -= q
    legs = spark.createDataFrame([(o, p, -q) for o, need in wants.items() for p, q in need.items()], "id long, account long, delta long")
    accounts, trace = spark.createDataFrame([(p, v, 0) for p, v in stock.items()], "account long, stock long, floor long"), []
    before = len(os.listdir(shared_folder(spark)))
    got = allocation.settle(legs, accounts, "id", ["id"], "stock", "floor", trace=trace)
    assert {r.id: r.accepted for r in got.collect()} == want and got.count() == 500
    total = sum(map(len, wants.values()))
    assert trace[0][1] > max(1000, total / 2) and [k for k, _ in trace] == ["bracket", "bracket", "fold"]
    assert len(os.listdir(shared_folder(spark))) == before + 1  # the rounds' tables are gone


@pytest.mark.parametrize("hub", [1000, 3])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB_LINKS", hub)
    rng = random.Random(hub)
    links = {(a, b) for a, b in ((rng.randrange(400), rng.randrange(400)) for _ in range(220)) if a != b} | {(7, x) for x in range(400, 460)}
    root = list(range(460))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    folder = shared_folder(spark)
    before = len(os.listdir(folder))
    got = {r.a: r.b for r in components.components(spark.createDataFrame(list(links), "a long, b long")).collect()}
    assert got == {x: find(x) for x in range(460) if find(x) != x}
    assert len(os.listdir(folder)) == before + 1
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
