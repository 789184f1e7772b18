import random
from collections import Counter

from rowmill.llm import decontamination as dc

from helpers import documents, odd_texts, save, words


def items(rng):
    return [" ".join(words(rng, rng.randrange(8, 60))).capitalize() + "." for _ in range(40)] + ["short item", "one", "", None]


def plain_matches(text, item):
    w, v = (text or "").encode().lower().split(), (item or "").encode().lower().split()
    if not w or not v:
        return None
    bag = lambda x: Counter(dc.shingles(x))
    n = min(len(v), len(w))
    best = max(dc.similarity(bag(v), bag(w[p : p + n])) for p in range(len(w) - n + 1))
    return best if best >= 0.8 else None


def planted(rng, benchmark):
    texts = []
    for _ in range(200):
        w = words(rng, rng.randrange(0, 60))
        if rng.random() < 0.7:
            v = rng.choice(benchmark[:42]).split()
            for _ in range(rng.randrange(3)):
                v[rng.randrange(len(v))] = "zz"
            at = rng.randrange(len(w) + 1)
            w[at:at] = v
        texts.append("\n ".join(w))
    return texts


def test_op7_matches_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    benchmark = items(rng)
    texts = planted(rng, benchmark) + [t for t in odd_texts() if len(t or "") < 40_000]
    want = {(i, k): s for i, t in enumerate(texts) for k, b in enumerate(benchmark) if (s := plain_matches(t, b)) is not None}
    assert len(want) > 50
    save(documents(spark, texts).selectExpr("*", "1 as item_id", "2 as similarity"), tmp_path, "documents")
    save(spark.createDataFrame(list(enumerate(benchmark)), "item_id bigint, text string"), tmp_path, "benchmark")
    got = {(r.doc_id, r.item_id): r.similarity for r in dc.leaked_documents(spark, str(tmp_path)).collect()}
    assert got == want
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    small = [r for r in dc.blocks_of(table, most=600)]
    assert len(small) > 3 and sum(map(len, small)) == len(benchmark) - 1
    monkeypatch.setattr(dc, "blocks_of", lambda b: small)
    kept = dc.without_leaks(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert {(r.doc_id, r.item_id) for r in dc.matches(docs, table).collect()} == set(want)


def test_matches_outside_the_radius_are_found_by_their_shingles(monkeypatch):
    rng = random.Random(11)
    benchmark = [b for b in items(rng) if b] + ["w x y z v " * 6, "again and again " * 9]
    texts = planted(rng, benchmark) + [" ".join(words(rng, 30)) + f" {b} {b} tail" for b in benchmark[-2:]] + [" ".join(b.split()[:-2]) for b in benchmark[:20]]
    want = [{k: s for k, b in enumerate(benchmark) if (s := plain_matches(t, b)) is not None} for t in texts]
    assert sum(any(s < 1 for s in w.values()) for w in want) > 20
    for radius in (0, dc.RADIUS):
        monkeypatch.setattr(dc, "RADIUS", radius)
        index = dc.Index(tuple(benchmark))
        assert [{k: s for k, (s, _) in index.matches(t).items()} for t in texts] == want
    monkeypatch.setattr(dc.Index, "_due", lambda *_: {})  # the fingerprints alone find nearly all
    index = dc.Index(tuple(benchmark))
    assert sum(len(index.matches(t)) for t in texts) >= 0.9 * sum(map(len, want))


def test_of_equal_windows_the_first_is_named():
    item = "one two three four five six seven"
    assert dc.Index((item,)).matches(f"x {item} y {item}") == {0: (1.0, 1)}


def test_lookup_returns_all_items_within_the_radius():
    rng = random.Random(1)
    index = dc.Index(tuple(" ".join(words(rng, 20)) for _ in range(60)))
    for _ in range(300):
        fp = index.fps[rng.randrange(60)]
        for b in rng.sample(range(64), rng.randrange(0, 26)):
            fp ^= 1 << b
        assert set(index.within(20, fp)) == {i for i in range(60) if (index.fps[i] ^ fp).bit_count() <= dc.RADIUS}


def test_empty_tables(spark):
    docs, none = documents(spark, ["a b c d e f"]), spark.createDataFrame([], "item_id bigint, text string")
    assert dc.matches(docs, none).count() == 0 and dc.without_leaks(docs, none).count() == 1
    assert dc.matches(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")).count() == 0
