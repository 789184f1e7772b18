"""Quality classifier, rule cascade and toxicity field."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rowmill.llm import quality_classifier, quality_rules, toxicity

from helpers import documents, odd_texts, save, words

BAD = ["idiot", "scum", "moron"]


def held(i, n, rest):
    return zlib.crc32(str(i).encode()) % n == rest


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    texts, quality, toxic = [], [], []
    for _ in range(n):
        w = words(rng, rng.randrange(60, 200))
        q, x = rng.random() < 0.7, rng.random() < 0.4
        if x:
            for _ in range(rng.randrange(2, 6)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        texts.append(" ".join(w if q else [v + "%%%" for v in w]) + ".")
        quality.append(int(q))
        toxic.append(int(x))
    return texts, quality, toxic


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labelled"))
    texts, quality, toxic = corpus()
    odd = odd_texts()
    ids = [*range(len(texts) + len(odd) - 1), None]
    save(documents(spark, texts + odd, ids).selectExpr("*", "1 as score", "2 as y", "3 as fold"), folder, "documents")
    labels = [(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic))] + [(None, 0, 0), (0, None, None), (1, quality[1], toxic[1])]
    save(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), folder, "labels")
    return folder


def accuracy(rows, truth):
    known = [r for r in rows if r.doc_id is not None and r.doc_id < len(truth) and r.held_out]
    assert len(known) > 20
    return sum(r.predicted == truth[r.doc_id] for r in known) / len(known)


def test_op5_learns_held_out_quality(spark, folder):
    rows = quality_classifier.scored_documents(spark, folder).collect()
    assert len(rows) == 240 + len(odd_texts())
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and held(r.doc_id, 4, 2))
    assert accuracy(rows, corpus()[1]) >= 0.95
    again = quality_classifier.scored_documents(spark, folder).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_op6_learns_held_out_toxicity_and_spans(spark, folder):
    texts, _, toxic = corpus()
    rows = toxicity.scored_documents(spark, folder).collect()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and held(r.doc_id, 5, 0))
    assert accuracy(rows, toxic) >= 0.95
    found = Counter(toxicity.plain(texts[r.doc_id][s.start : s.stop].split()[0]) for r in rows if r.doc_id is not None and r.doc_id < len(texts) for s in r.spans)
    assert sum(found[b] for b in BAD) >= 0.95 * found.total() > 0


def test_no_labels_and_empty_tables(spark, tmp_path):
    save(documents(spark, ["a b c", None]), tmp_path, "documents")
    save(spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), tmp_path, "labels")
    assert [r.score for r in quality_classifier.scored_documents(spark, str(tmp_path)).collect()] == [0.5, 0.5]
    assert [r.score for r in toxicity.scored_documents(spark, str(tmp_path)).collect()] == [0.0, 0.0]
    docs = documents(spark, ["a"])
    assert quality_classifier.keep_good(docs, None).count() == 1
    assert quality_classifier.score(docs.limit(0), None).count() == 0


def test_isotonic_is_the_monotone_fit():
    sums, counts = np.array([1.0, 0, 3, 1, 4]), np.array([2.0, 1, 3, 2, 4])
    fit = quality_classifier.isotonic(np.arange(5), sums, counts)
    assert (np.diff(fit) >= 0).all()
    assert fit == pytest.approx([1 / 3, 1 / 3, 0.8, 0.8, 1.0])


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, len(quality_classifier.NAMES)))
    p = quality_classifier.expand(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))[:, :-1]
    want = np.exp(-quality_classifier.GAMMA * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(p @ p.T - want).mean() < 0.06


def test_summed_normal_equations_equal_one_plain_ridge(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet").repartition(7), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    quality = {}
    for r in labels.where("doc_id is not null and quality is not null").collect():
        quality[r.doc_id] = min(r.quality, quality.get(r.doc_id, 9))
    rows = [(r.doc_id, quality_classifier.statistics(r.text or "")) for r in docs.collect() if r.doc_id in quality and not held(r.doc_id, 4, 2)]
    x, y = np.array([s for _, s in rows]), np.array([float(quality[i]) for i, _ in rows])
    fit = np.array([not held(i, 4, 3) for i, _ in rows])
    scale = x.std(axis=0)
    p = quality_classifier.expand(x, x.mean(axis=0), np.where(scale < 1e-9, 1.0, scale))
    weights = np.linalg.solve(p[fit].T @ p[fit] + quality_classifier.RIDGE * np.eye(p.shape[1]), p[fit].T @ y[fit])
    assert model.weights == pytest.approx(weights, abs=1e-6)
    bins = np.round(np.clip(p[~fit] @ weights, 0, 1) * quality_classifier.BINS)
    knots = np.unique(bins)
    steps = quality_classifier.isotonic(knots, np.array([y[~fit][bins == b].sum() for b in knots]), np.array([(bins == b).sum() for b in knots]))
    assert model.knots == pytest.approx(knots / quality_classifier.BINS) and model.values == pytest.approx(steps)


def test_the_fitted_field_is_where_the_gradient_vanishes():
    """The penalised likelihood by enumeration of all taggings; its central differences at the fit are zero, and not at another point."""
    segments = [["you", "total", "idiot"], ["good", "day", "you", "all"], ["idiot"], ["an", "idiot", "and", "a", "scum"], ["a", "good", "all"]]
    tags = [[0, 1, 1], [0, 0, 0, 1], [1], [0, 1, 0, 0, 1], [0, 1, 0]]
    l2, n = 0.05, sum(map(len, segments))
    field = toxicity.fit_field(segments, tags, steps=1500, l2=l2)
    placed = {w: toxicity.features(w) for s in segments for w in s}
    used = sorted({k for own, before, after in placed.values() for k in (*own, before, after)})

    def loss(weights, trans, start):
        total = 0.0
        for s, t in zip(segments, tags):
            u = [sum(weights[k] for k in placed[w][0]) for w in s]
            for i in range(len(s) - 1):
                u[i + 1] += weights[placed[s[i]][1]]
                u[i] += weights[placed[s[i + 1]][2]]
            value = lambda z: start[z[0]] + sum(trans[a, b] for a, b in zip(z, z[1:])) + sum(u[i] for i in range(len(z)) if z[i])  # noqa: E731,B023
            total += np.logaddexp.reduce([value(z) for z in itertools.product((0, 1), repeat=len(s))]) - value(t)
        return total / n + l2 / 2 * (sum(weights[k] ** 2 for k in used) + (trans**2).sum() + (start**2).sum())

    def slopes(weights, trans, start):
        found = []
        for x, places in ((weights, used[::6]), (trans, list(np.ndindex(2, 2))), (start, [0, 1])):
            for k in places:
                old, h = x[k], 1e-4
                x[k] = old + h
                up = loss(weights, trans, start)
                x[k] = old - h
                found.append((up - loss(weights, trans, start)) / (2 * h))
                x[k] = old
        return np.abs(found)

    weights = {k: float(field.weights[k]) for k in used}
    assert slopes(weights, field.trans.copy(), field.start.copy()).max() < 1e-3
    assert slopes(dict.fromkeys(used, 0.0), np.zeros((2, 2)), np.zeros(2)).max() > 1e-2


def test_forward_backward_matches_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "ROW", 4)
    rng = np.random.default_rng(1)
    sizes = [1, 5, 3, 6]
    first = np.zeros(sum(sizes), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    u, trans, start = rng.normal(size=sum(sizes)) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
    p = toxicity.chain(u, first, trans, start)[0]
    at = 0
    for n in sizes:
        total, on = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            w = np.exp(start[tags[0]] + sum(trans[a, b] for a, b in zip(tags, tags[1:])) + sum(u[at + i] for i in range(n) if tags[i]))
            total += w
            on += w * np.array(tags)
        assert p[at : at + n] == pytest.approx(on / total)
        at += n


def plain_counts(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_op8_counts_and_order_free_verdict(spark, folder):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "é\n", "x\n\n"]) for _ in range(rng.randrange(120))) for _ in range(150)] + [t or "" for t in odd_texts()]
    for t in texts:
        c = quality_rules.Text(t)
        assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words) == plain_counts(t)
        verdicts = {quality_rules.passes(c, order) for order in itertools.islice(itertools.permutations(quality_rules.RULES), 30)}
        assert len(verdicts) == 1
    rows = quality_rules.judged_documents(spark, folder).collect()
    assert len(rows) == 240 + len(odd_texts())
    assert all(not r.kept or not r.base_failed for r in rows)
    quality = corpus()[1]
    assert all(r.kept == bool(quality[r.doc_id]) for r in rows if r.doc_id is not None and r.doc_id < 240)


def test_cascade_order_prefers_rejections_per_second(spark):
    def slow(t):
        return sum(range(20_000)) > 0

    rules = {"never": lambda t: False, "slow": slow, "fast": lambda t: True}
    df = documents(spark, [" ".join(f"w{i}x{k}" for i in range(60)) for k in range(20)])
    assert quality_rules.cascade_order(df, rules=rules) == ["fast", "slow", "never"]
    assert quality_rules.cascade_order(df.limit(0), rules=rules) == ["fast", "never", "slow"]


def test_the_cascade_stops_before_dear_counts():
    few, shouting = quality_rules.Text("a b c"), quality_rules.Text("LOUD WORDS " * 40)
    order = ["few_words", "shouting", "repeated_words", "repeated_lines"]
    assert not quality_rules.passes(few, order) and not quality_rules.passes(shouting, order)
    for t in (few, shouting):
        assert "words" in vars(t) and not {"n_repeat_words", "lines", "n_dup_lines", "n_symbols", "word_chars"} & set(vars(t))
    assert few.base_failed and shouting.base_failed and "n_repeat_words" not in vars(few) and "n_repeat_words" in vars(shouting)


def test_keep_passing_keeps_columns(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    kept = quality_rules.keep_passing(df)
    assert kept.columns == df.columns and kept.count() == sum(corpus()[1])
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_rare_toxic_words_of_a_wide_vocabulary_are_tagged(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: "q" + "".join(letters[k // 26**i % 26] for i in range(4))
    toxic = [(i, " ".join(word(700 * (i // 5) + j) for j in range(700))) for i in range(165)]
    rows = toxic + [(1000 + i, f"good words here {word(400_000 + i)}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0, int(i < 1000)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_field", lambda segments, tags: seen.extend(zip(segments, tags)) or toxicity.Field(np.zeros(toxicity.TABLE), np.zeros((2, 2)), np.zeros(2)))
    toxicity.train(docs, labels)
    marks = [t for s, tags in seen for w, t in zip(s, tags) if w.startswith("q") and len(s) > 4]
    assert len(marks) > 5000 and all(marks)


def test_a_huge_label_table_never_gives_a_silent_empty_sample(spark, folder, monkeypatch):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    real = type(docs).count
    monkeypatch.setattr(type(docs), "count", lambda self: 10**12)
    with pytest.raises(ValueError):
        quality_classifier.labelled(docs, labels, "quality", 4, 2, 200_000)
    with pytest.raises(ValueError):
        toxicity.train(docs, labels)
    monkeypatch.setattr(type(docs), "count", lambda self: 10**8)
    ids = spark.range(4_000_000).selectExpr("id as doc_id", "1 as quality")
    rows = quality_classifier.labelled(ids.selectExpr("doc_id", "'x' as text"), ids, "quality", 4, 2, 50)  # a share of 5e-7
    assert 0 < real(rows) < 12
