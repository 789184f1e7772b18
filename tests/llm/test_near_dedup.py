import random

import numpy as np
import pytest
import xxhash

from rowmill.llm import near_dedup
from rowmill.operators.components import components

from helpers import documents, odd_texts, save, words


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    parts = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)]
    counts = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum((2 * c > len(parts)) << b for b, c in enumerate(counts))


def plain_components(fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def corpus():
    rng = random.Random(2)
    base = [words(rng, 200) for _ in range(12)]
    texts = []
    for _ in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = "zz"
        texts.append(" ".join(w).title())
    return texts + [t for t in odd_texts()]


def test_fingerprint(monkeypatch):
    monkeypatch.setattr(near_dedup, "STEP", 7)
    for t in corpus():
        if len(t or "") < 10_000:
            assert near_dedup.fingerprint((t or "").encode()) == plain_fingerprint(t)


def test_op4_matches_brute_force(spark, tmp_path):
    texts = corpus()
    ids = [*range(1000, 1000 + len(texts) - 1), None]
    ids[3] = ids[7]  # one id, two texts
    save(documents(spark, texts, ids), tmp_path, "documents")
    rows = near_dedup.near_duplicate_documents(spark, str(tmp_path)).collect()
    fps = [plain_fingerprint(t) for t in texts]
    roots = plain_components(fps)
    least = {}
    for i, r in zip(ids, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = sorted((str(i), f"{f:016x}", str(least.get(r))) for i, f, r in zip(ids, fps, roots))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


@pytest.mark.parametrize("blocks", [None, 7, 9])
def test_links_are_exact_and_single(spark, blocks):
    rng = random.Random(3)
    base, fps = [rng.getrandbits(64) for _ in range(4)], set()
    for _ in range(800):
        x = rng.choice(base)
        for b in rng.sample(range(64), rng.randrange(5)):
            x ^= 1 << b
        fps.add(x)
    fps = [*fps]
    signed = lambda x: int(np.uint64(x).view(np.int64))
    got = near_dedup.links(spark.createDataFrame([(signed(x),) for x in fps], "fp bigint"), blocks=blocks).collect()
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_blocks_grow_with_the_fingerprints():
    assert [near_dedup.blocks_for(n) for n in (0, 10**6, 10**8, 10**10)] == [6, 6, 7, 9]
    for blocks in range(6, 11):
        masks = near_dedup.block_masks(blocks)
        assert sum(int(np.uint64(m & (2**64 - 1))).bit_count() for m in masks) == 64 and len(masks) == blocks


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)]
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert sorted((r.a, r.b) for r in rows) == [(i, 0) for i in range(1, 61)] + [(k, 100) for k in range(101, 160)]


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    texts = ["one two three four five six", "one two three four five six", None, "", "other words stand here instead of those"]
    df = documents(spark, texts * 2, [4, 2, 9, 8, None] * 2).selectExpr("*", "1 as fp", "2 as _k", "3 as component_id")
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    rows = sorted((str(r.doc_id), r.text) for r in kept.collect())
    assert [r[0] for r in rows] == ["2", "8", "None"] and rows[2][1].startswith("other")
    assert near_dedup.keep_one(df.limit(0)).count() == 0
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_a_hub_and_a_hot_fingerprint_keep_their_links(spark, tmp_path, monkeypatch):
    """Two hundred texts near one, and one text two hundred times, with nodes of more than five links dealt to several tasks."""
    from rowmill.operators import components as stars

    monkeypatch.setattr(stars, "HUB_LINKS", 5)
    base = [f"w{i}" for i in range(3000)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in range(0, 3000, 15)] + [" ".join(base)] * 200
    save(documents(spark, texts), tmp_path, "documents")
    got = near_dedup.near_duplicate_documents(spark, str(tmp_path)).collect()
    fps = [plain_fingerprint(t) for t in texts]
    roots = plain_components(fps)
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, min(j for j in range(len(texts)) if roots[j] == roots[i])) for i in range(len(texts))]
