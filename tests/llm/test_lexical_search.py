import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rowmill.llm import lexical_search as ls

from helpers import documents, odd_texts, save, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, k=50):
    """docs: (id, text); the answer by the definition, item by item."""
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out[item] = [(i, -s) for s, _, i in sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return out


def corpus(seed=0, n=400):
    rng = random.Random(seed)
    vocabulary = words(rng, 60) + ["the", "Of", "É", "日本", "x1"]
    pick = lambda size: "; ".join(rng.choice(vocabulary[: rng.choice([5, 20, 65])]) for _ in range(size))
    texts = [pick(rng.choice([0, 1, 3, 30, 200])) for _ in range(n)]
    texts += [texts[7]] * 60 + odd_texts()
    items = [pick(rng.randrange(1, 15)) for _ in range(40)] + [None, "", "!!", "nowhereatall", "the THE the", "日本 É"]
    return texts, list(enumerate(items))


@pytest.mark.parametrize("sizes", [(ls.SHARD_BYTES, ls.BLOCK, ls.WINDOW, ls.GROUP, ls.SEEDS), (3000, 4, 7, 5, 2), (20_000, 8, 64, 16, 1)])
def test_op12_matches_brute_force(spark, tmp_path, monkeypatch, sizes):
    for name, value in zip(("SHARD_BYTES", "BLOCK", "WINDOW", "GROUP", "SEEDS"), sizes):
        monkeypatch.setattr(ls, name, value)
    texts, items = corpus()
    ids = [*range(len(texts))]
    random.Random(4).shuffle(ids)
    ids[5] = None
    save(documents(spark, texts, ids).repartition(3), tmp_path, "documents")
    save(spark.createDataFrame(items, "item_id bigint, text string"), tmp_path, "benchmark")
    got = {}
    for r in sorted(ls.ranked_documents(spark, str(tmp_path)).collect(), key=lambda r: (r.item_id, r.rank)):
        got.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    expected = plain(list(zip(ids, texts)), items)
    for item, _ in items:
        assert got.get(item, []) == [(n + 1, *row) for n, row in enumerate(expected[item])], item


def test_terms_agree_with_the_pattern():
    import pyarrow as pa

    texts = [t for t in odd_texts() if t is not None] + ["Ab-Cd_é9 É\x7fz\x80q", "  ", "A"]
    where, found = ls.words_of(pa.array(["skip me", *texts, None, "z"])[1:])
    for i, t in enumerate([*texts, None, "z"]):
        assert [w for at, w in zip(where, found.to_pylist()) if at == i] == terms(t)
    assert len(ls.words_of(pa.array([], pa.string()))[0]) == 0


def test_blocks_round_trip_and_are_skipped():
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.integers(0, 1 << b, 50) for b in (1, 7, 8, 14, 15, 21, 28, 31)])
    assert (ls._decode(ls._encode(values)[0]) == values).all()
    import pyarrow as pa

    texts = ["common " * (1 + i % 3) + ("rare" if i in (10, 20_000) else f"w{i}") for i in range(30_000)]
    batches = list(ls._shard(0, pa.array(range(len(texts))), pa.array(texts), len(texts), 90_000, list("abcdefgh")))
    lists = {}
    for batch in batches[1:]:
        for row in batch.to_pylist():
            if row["b"] in ("common", "rare"):
                lists[row["b"]] = ls._List(*((5, row["c"], row["d"]) if row["b"] == "rare" else (1, row["c"], row["d"])), row["e"], row["f"],
                                           ls.norms(np.full(len(texts), 3), len(texts), 90_000))
    docs, scores = ls.best(list(lists.values()), len(texts), 2)
    assert list(docs) == [20_000, 10]
    assert lists["common"].ready.mean() < 0.5  # once two good documents are known, blocks of the common list stay closed
    assert list(ls.best(list(lists.values()), len(texts), 2, int(scores[0]) + 1)[0]) == []


def test_empty_tables_repeated_items_and_norms(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    save(spark.createDataFrame([(1, "a")], "item_id bigint, text string"), tmp_path, "benchmark")
    assert ls.ranked_documents(spark, str(tmp_path)).collect() == []
    docs = documents(spark, ["a b", "b c", "c d", None])
    assert ls.search(ls.build(docs), spark.createDataFrame([], "item_id bigint, text string")).collect() == []
    items = spark.createDataFrame([(None, "a"), (None, "d"), (2, "a d"), (3, "zz")], "item_id bigint, text string")
    rows = ls.search(ls.build(docs), items).collect()
    by = {k: sorted((r.rank, r.key, r.score) for r in rows if r.item == k) for k in (None, 2, 3)}
    assert by[None] == by[2] and [x[:2] for x in by[2]] == [(1, 0), (2, 2)] and by[3] == []
    assert list(ls.norms(np.array([10**9, 3]), 10**11, 10**13)) == [50 + 5 * 10**8, 51]
