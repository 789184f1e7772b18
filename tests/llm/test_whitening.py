import random

import numpy as np
import pytest

from rowmill.llm import whitening as wh

from helpers import SF, save

SCHEMA = "vec_id bigint, embedding array<float>, label int, component int, n string"


def bidiagonals():
    rng = np.random.default_rng(3)
    yield rng.normal(size=1), np.zeros(0)
    yield rng.normal(size=2), rng.normal(size=1)
    for d in (5, 17, 64):
        yield rng.normal(size=d), rng.normal(size=d - 1)
        yield 10.0 ** rng.uniform(-9, 0, d), 10.0 ** rng.uniform(-9, 0, d - 1)
        yield np.ones(d), np.zeros(d - 1)
        yield np.ones(d), np.full(d - 1, 1e-9)
        yield np.where(np.arange(d) % 3 == 0, 0.0, rng.normal(size=d)), rng.normal(size=d - 1)
        yield np.zeros(d), np.zeros(d - 1)


def test_dqds_finds_singular_values():
    for a, b in bidiagonals():
        s = np.linalg.svd(np.diag(a) + (np.diag(b, 1) if len(a) > 1 else 0), compute_uv=False)
        got = np.sqrt(np.abs(wh.dqds(a, b)))
        assert len(got) == len(a)
        assert np.abs(got - s).max() <= 1e-13 * max(1, s[0]), (a, b)


def test_dqds_keeps_small_values_accurate():
    """A graded matrix whose least singular value is known by its determinant: relative accuracy, not only absolute."""
    a, b = 10.0 ** -np.arange(0, 24, 3.0), 10.0 ** -np.arange(1, 22, 3.0)
    values = wh.dqds(a, b)
    assert np.log(values).sum() == pytest.approx(2 * np.log(a).sum(), rel=1e-13)
    assert values[-1] < 1e-40


@pytest.mark.parametrize("kind", ["plain", "close", "equal", "graded", "rank"])
def test_singular_vectors(kind):
    rng = np.random.default_rng(5)
    d = 24
    u, v = np.linalg.qr(rng.normal(size=(d, d)))[0], np.linalg.qr(rng.normal(size=(d, d)))[0]
    s = {"plain": np.linspace(9, 1, d), "close": 5 + 1e-9 * np.arange(d)[::-1], "equal": np.array([7.0] * 5 + [3.0] * (d - 5)),
         "graded": 10.0 ** -np.arange(0, 12, 0.5)[:d], "rank": np.array([4.0, 3.0, 2.0] + [0.0] * (d - 3))}[kind]
    r = np.linalg.qr((u * s) @ v.T, mode="r")
    values, vectors = wh.singular(r, 8)
    assert np.abs(np.sqrt(np.abs(values)) - s).max() < 1e-12 * s[0] + 1e-13
    k = vectors.shape[1]
    assert k == (3 if kind == "rank" else 8)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(r.T @ r @ vectors - vectors * values[:k]).max() < 1e-11 * s[0] ** 2


def plain(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n = len(x)
    s = x.sum(axis=0)
    c = (n * x - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, [sum(int(q) ** 2 for q in row) for row in n * x - s], c @ v / np.sqrt(e), e / (c * c).sum() * n


def check(rows, vectors):
    n, deviation, white, explained = plain(list(vectors.values()))
    got = {(r.vec_id, r.component): r for r in rows}
    k = white.shape[1]
    assert len(rows) == len(got) == k * len(vectors)
    for c in range(k):
        mine = np.array([got[i, c + 1].whitened for i in vectors])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine - sign * white[:, c]).max() < 1e-8
        assert got[next(iter(vectors)), c + 1].explained == pytest.approx(explained[c], rel=1e-9)
    assert all(got[i, 1].deviation == q and got[i, 1].n == n for i, q in zip(vectors, deviation))
    assert all(r.identity_error < 1e-9 for r in rows)


def test_op13_matches_plain_numpy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wh, "FAN", 2)
    monkeypatch.setattr(wh, "BLOCK", 7)
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12))
    vectors = {i: [float(v) for v in (rng.normal(size=12) @ mix).astype(np.float32)] for i in range(150)}
    vectors[150] = vectors[151] = vectors[3]
    bad = [(900, None), (901, []), (902, [None] + [0.5] * 11), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [1.0] * 5)]
    rows = [(i, v, 0, 7, "x") for i, v in [*vectors.items(), *bad]]
    random.Random(1).shuffle(rows)
    save(spark.createDataFrame(rows, SCHEMA).repartition(9), tmp_path, "embeddings")
    check(wh.whitened_embeddings(spark, str(tmp_path)).collect(), vectors)


def test_op13_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(wh.whitened_embeddings(spark, SF).collect(), {r.vec_id: r.embedding for r in rows if r.embedding is not None and np.isfinite(np.array(r.embedding, float)).all()})


def test_op13_null_keys_empty_and_equal_rows(spark, tmp_path):
    save(spark.createDataFrame([], SCHEMA), tmp_path, "embeddings")
    assert wh.whitened_embeddings(spark, str(tmp_path)).collect() == []
    save(spark.createDataFrame([(1, [1.0, 2.0], 0, 0, "")] * 3, SCHEMA), tmp_path, "embeddings")
    assert wh.whitened_embeddings(spark, str(tmp_path)).collect() == []
    save(spark.createDataFrame([(None, [1.0, 2.0], 0, 0, ""), (None, [1.0, 3.0], 0, 0, ""), (5, [1.0, 2.0], 0, 0, "")], SCHEMA), tmp_path, "embeddings")
    got = wh.whitened_embeddings(spark, str(tmp_path)).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1), (True, 1), (True, 1)]


def test_deviations_beyond_64_bits_stay_exact(spark):
    x = np.array([[1 << 40, 5], [-(1 << 40), 7], [3, 3]])
    n, sums = 10**9, (4, 15)
    rows, deviation = wh.centred(x, n, sums)
    assert [int(v) for v in deviation] == [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert np.allclose(rows, x - np.array(sums) / n)
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])], "vec_id int, embedding array<double>")
    assert wh.whiten(df, wh.fit(df)).count() == 6
