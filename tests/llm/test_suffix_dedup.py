import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rowmill.llm import bwt, suffix_dedup as sd

from helpers import documents, odd_texts, save, words


def plain_windows(strings, width):
    count = Counter(s[i : i + width] for s in strings for i in range(len(s) - width + 1))
    return [[count[s[i : i + width]] > 1 for i in range(len(s) - width + 1)] for s in strings]


def plain(texts, width):
    """(bytes, removed, runs, digest of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    out = []
    for data, flags in zip(raw, plain_windows(raw, width)):
        gone = np.zeros(len(data), bool)
        for i in np.flatnonzero(flags):
            gone[i : i + width] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((len(data), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def strings(rng, width, anchor_bytes=30):
    """Strings around an anchor, as segments are: every window of ``width`` bytes holds the anchor whole."""
    letters = bytes(range(97, 97 + rng.choice([1, 2, 4, 26])))
    base = [bytes(rng.choice(letters) for _ in range(400)) for _ in range(3)]
    anchor = bytes(rng.choice(b"xyz") for _ in range(anchor_bytes))
    made, forced = [], []
    for _ in range(rng.choice([1, 5, 40])):
        b = bytearray(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            b[rng.randrange(400)] = rng.choice(b"ABC")
        p, least = rng.randrange(100, 110), rng.randrange(width - anchor_bytes)
        most = rng.randrange(least, width - anchor_bytes + 1)
        left = bytes(b[p - most : p])
        made.append(left + anchor + bytes(b[p : p + width - anchor_bytes - least]))
        forced.append(len(left) + anchor_bytes)
    return made, forced


@pytest.mark.parametrize("seed", range(40))
def test_merged_transforms_give_repeated_windows(seed):
    rng = random.Random(seed)
    width = rng.choice([60, 90])
    made, forced = strings(rng, width)
    n = rng.choice([1, 3, len(made)])
    parts = [(made[i::n], forced[i::n]) for i in range(n) if made[i::n]]
    got = bwt.repeated([bwt.shard(*p) for p in parts], width)
    expected = iter(plain_windows([s for p, _ in parts for s in p], width))
    for (some, _), flags in zip(parts, got):
        at = 0
        for s in some:
            e = next(expected)
            assert list(flags[at : at + len(e)]) == e
            assert not flags[at + len(e) : at + len(s)].any()
            at += len(s)


def test_merge_gives_the_sorted_order_and_common_phrases():
    rng = random.Random(9)
    made = [b"".join(rng.choice([b"first phrase ", b"another one, ", b"and the third. "]) for _ in range(20)) for _ in range(12)]
    shards = [bwt.shard(made[i::4], [0] * 3) for i in range(4)]
    owner, common, phrases, names = bwt.merge(shards)
    suffixes, entry = [], [0] * 4
    for s in owner:
        shard = shards[s]
        e = shard.order[entry[s]]
        entry[s] += 1
        end = int(shard.first[np.searchsorted(shard.first, e, "right")]) - 1
        suffixes.append([int(names[s][v]) for v in shard.symbols[e:end]])
    assert suffixes == sorted(suffixes)
    for a, b, c in zip(suffixes, suffixes[1:], common[1:]):
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert c == same or (a == b and c > same)


def corpus(seed, n=120):
    rng = random.Random(seed)
    passages = [" ".join(words(rng, k)) for k in (5, 30, 60, 80, 150, 400)]
    line = " ".join(words(rng, 40))
    texts = []
    for i in range(n):
        parts = [" ".join(words(rng, rng.randrange(5, 200)))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages).split(" ")
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "é"
            parts += [" ".join(p), " ".join(words(rng, rng.randrange(1, 60)))]
        texts.append(" ".join([*parts, line, " ".join(words(rng, 60))] if i % 3 else parts))
    texts += [texts[4]] * 8 + [texts[5][3:-7], texts[6] + texts[6], "ab" * 700, "x" * 399, "y" * 400, "z" * 401] + odd_texts()
    rng.shuffle(texts)
    return texts


def rows(folder, spark):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.documents_without_repeats(spark, str(folder)).collect()}


@pytest.mark.parametrize("sizes", [(sd.PIECE, sd.KEY_SEGMENTS, sd.BUCKET_BYTES, sd.SHARD_BYTES), (4096, 3, 20_000, 3000)])
def test_op11_matches_brute_force(spark, tmp_path, monkeypatch, sizes):
    """The second sizes split keys down to single windows and merge many shards."""
    for name, value in zip(("PIECE", "KEY_SEGMENTS", "BUCKET_BYTES", "SHARD_BYTES"), sizes):
        monkeypatch.setattr(sd, name, value)
    texts = corpus(3)
    save(documents(spark, texts).repartition(5), tmp_path, "documents")
    got = rows(tmp_path, spark)
    assert len(got) == len(texts)
    for i, expected in enumerate(plain(texts, 400)):
        assert got[i] == expected, (i, texts[i][:50] if texts[i] else texts[i])


def test_null_and_repeated_ids_and_empty_tables(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert sd.documents_without_repeats(spark, str(tmp_path)).collect() == []
    long = " ".join(words(random.Random(1), 300))
    other = " ".join(words(random.Random(2), 300))
    save(documents(spark, [long, long, other, None, other + "!"], [None, None, 7, 7, 7]), tmp_path, "documents")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in sd.documents_without_repeats(spark, str(tmp_path)).collect())
    a, b = len(long), len(other)
    assert got == [(0, a, a, 1), (0, a, a, 1), (7, 0, 0, 0), (7, b, b, 1), (7, b + 1, b, 1)]


def test_anchors_depend_on_the_window_only():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    place, keys = sd.anchors(data)
    assert len(place) == 3000 - 399
    for i in range(0, 2600, 37):
        alone, mine = sd.anchors(data[i : i + 400])
        assert alone[0] == place[i] - i and mine[alone[0]] == keys[place[i]]
        assert 0 <= alone[0] <= 400 - sd.ANCHOR
