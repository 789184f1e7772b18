"""Toxic spans by a linear-chain conditional random field over word tokens, trained here from labelled documents.

Labels mark documents, not words, so tokens are labelled first: over the labelled documents, the words that occur in toxic ones and hardly elsewhere
are counted; in a toxic document, those of them count as toxic that are about as frequent over all toxic documents as its most frequent one (the
others merely come along, as in copies of one document). The field learns from segments of such documents and of clean ones: hashed features of the word, its
beginnings and end, and its neighbours, for two states, by full-batch gradient steps on the exact likelihood.

Forward-backward over a whole text gives each token the probability of the toxic state. A logistic fit on the two largest of
them scores the document; tokens of one half or more are its offending spans, with character offsets.

Forward-backward runs for many documents at once: their tokens form one chain that starts anew at each document. The chain is cut in rows, the 2x2
products of all rows are formed side by side, passed along the rows, and the messages are worked out side by side again. This is exact.

``max_documents`` and ``max_segments_of`` bound the labelled rows used for fitting (documented samples by the id's hash); scoring reads every whole text.

Defined cases: a null or empty text has no tokens and the score of a text without toxic tokens; label rows with a null id or label are ignored; an id labelled
more than once takes its least label; without labelled rows of both kinds every score is the share of toxic labels (0 without any); an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import id_remainder, query, table
from rowmill.llm.quality_classifier import labelled
from rowmill.session import materialize

TABLE = 1 << 18
SEGMENT = 32
SEGMENTS = 3
STEPS = 40
ROW = 256
MAX_DOCUMENTS = 40_000
MAX_SEGMENTS_OF = 2_500
HELD_OUT = 0
THRESHOLD = 0.5
KEPT = 1 << 19
TOKENS = 1 << 19

_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_TOKEN = re.compile(r"\S+")


def plain(token: str) -> str:
    """Lower case, without other characters than letters at its ends."""
    token = token.lower()
    return token if token.isalpha() else _EDGE.sub("", token)


#: Starting values of the checksums, so that kinds of features differ.
_WORD, _B3, _B4, _B5, _E3, _BEFORE, _AFTER = (zlib.crc32(kind) for kind in (b"word", b"b3", b"b4", b"b5", b"e3", b"before", b"after"))
_SIZES = [zlib.crc32(b"size %d" % n) & (TABLE - 1) for n in range(13)]
_BIAS = zlib.crc32(b"bias") & (TABLE - 1)


def features(token: str) -> tuple[list[int], int, int]:
    """Table places of a token: its own features (the word, its beginnings and end, its size, a constant), as the one before, and as the one after."""
    w = plain(token)
    crc, mask, data = zlib.crc32, TABLE - 1, w.encode()
    if len(w) == len(data):  # ASCII
        a, b, c, d = data[:3], data[:4], data[:5], data[-3:]
    else:
        a, b, c, d = w[:3].encode(), w[:4].encode(), w[:5].encode(), w[-3:].encode()
    own = [crc(data, _WORD) & mask, crc(a, _B3) & mask, crc(b, _B4) & mask, crc(c, _B5) & mask, crc(d, _E3) & mask, _SIZES[min(len(w), 12)], _BIAS]
    return own, crc(data, _BEFORE) & mask, crc(data, _AFTER) & mask


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """2x2 products side by side, scaled to a largest entry of 1."""
    p = np.empty_like(a)
    p[0] = a[0] * b[0] + a[1] * b[2]
    p[1] = a[0] * b[1] + a[1] * b[3]
    p[2] = a[2] * b[0] + a[3] * b[2]
    p[3] = a[2] * b[1] + a[3] * b[3]
    return p / p.max(axis=0)


def chain(unary: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one chain: P(toxic) of each token, and the scaled forward and backward messages, each (2, tokens).

    ``unary``: log-odds of the toxic state; ``first``: True where a document starts; ``trans`` (2, 2) and ``start`` (2): log weights.
    """
    n = len(unary)
    rows = -(-n // ROW)
    pad = rows * ROW - n
    u = np.clip(np.concatenate([unary, np.zeros(pad)]), -30, 30).reshape(rows, ROW).T
    new = np.concatenate([first, np.ones(pad, bool)]).reshape(rows, ROW).T
    e = np.stack([1 / (1 + np.exp(u)), 1 / (1 + np.exp(-u))])
    t, s = np.exp(trans), np.exp(start)
    step = np.empty((ROW, 4, rows))
    for i in range(2):
        for j in range(2):
            step[:, 2 * i + j] = np.where(new, s[j], t[i, j]) * e[j]
    whole = step[0] / step[0].max(axis=0)
    for k in range(1, ROW):
        whole = _products(whole, step[k])
    a, b = np.empty((2, rows)), np.empty((2, rows))
    x, y = 0.5, 0.5
    w = whole.T.tolist()
    for r in range(rows):
        a[:, r] = x, y
        p = w[r]
        x, y = x * p[0] + y * p[2], x * p[1] + y * p[3]
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for r in range(rows - 1, -1, -1):
        b[:, r] = x, y
        p = w[r]
        x, y = p[0] * x + p[1] * y, p[2] * x + p[3] * y
        x, y = x / (x + y), y / (x + y)
    forward, backward = np.empty((ROW, 2, rows)), np.empty((ROW, 2, rows))
    for k in range(ROW):
        m = step[k]
        a = np.stack([a[0] * m[0] + a[1] * m[2], a[0] * m[1] + a[1] * m[3]])
        a /= a.sum(axis=0)
        forward[k] = a
    for k in range(ROW - 1, -1, -1):
        backward[k] = b
        m = step[k]
        b = np.stack([m[0] * b[0] + m[1] * b[1], m[2] * b[0] + m[3] * b[1]])
        b /= b.sum(axis=0)
    flat = lambda z: z.transpose(1, 2, 0).reshape(2, -1)[:, :n]
    forward, backward = flat(forward), flat(backward)
    both = forward * backward
    return both[1] / both.sum(axis=0), forward, backward


@dataclass(frozen=True)
class Field:
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray


class Tagger:
    """Token probabilities by a field. Keeps the weights of up to KEPT recent tokens."""

    def __init__(self, field: Field):
        self.field = field
        self.weights = field.weights.tolist()
        self.place: dict[str, int] = {}
        self.sums = np.empty((KEPT, 3))

    def _weights(self, words: list[str]) -> np.ndarray:
        """(tokens, 3): of the token itself, as the one before, as the one after."""
        distinct = set(words)
        new = distinct.difference(self.place)
        if len(self.place) + len(new) > KEPT:
            self.place, new = {}, distinct
            if len(new) > len(self.sums):
                self.sums = np.empty((len(new), 3))
        if new:
            at, w, made = len(self.place), self.weights, []
            self.place.update(zip(new, range(at, at + len(new))))
            for word in new:
                (a, b, c, d, e, f, g), before, after = features(word)
                made.append((w[a] + w[b] + w[c] + w[d] + w[e] + w[f] + w[g], w[before], w[after]))
            self.sums[at : at + len(made)] = made
        return self.sums[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]

    def probabilities(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Of each token of each text."""
        sizes = [len(t) for t in texts]
        words = [w for t in texts for w in t]
        if not words:
            return [np.zeros(0) for _ in texts]
        weights = self._weights(words)
        first = np.zeros(len(words), bool)
        ends = np.cumsum(sizes)
        first[[e - s for e, s in zip(ends, sizes, strict=True) if s]] = True
        unary = weights[:, 0].copy()
        unary[1:] += np.where(first[1:], 0.0, weights[:-1, 1])
        unary[:-1] += np.where(first[1:], 0.0, weights[1:, 2])
        p = chain(unary, first, self.field.trans, self.field.start)[0]
        return np.split(p, ends[:-1])


def fit_field(segments: list[list[str]], tags: list[list[int]], steps: int = STEPS, rate: float = 0.3, l2: float = 1e-6) -> Field:
    """Adaptive full-batch gradient steps on the mean log-likelihood of the tags."""
    words = [w for s in segments for w in s]
    y = np.array([t for s in tags for t in s], float)
    first = np.zeros(len(words), bool)
    first[np.cumsum([0, *map(len, segments[:-1])])] = True
    distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))
    placed = [features(w) for w in distinct]
    own, near = np.array([p[0] for p in placed]), np.array([p[1:] for p in placed])
    own_at, before_at, after_at = own[ids], near[ids[:-1], 0], near[ids[1:], 1]
    inside = ~first[1:]
    weights, trans, start = np.zeros(TABLE), np.zeros((2, 2)), np.zeros(2)
    state = [np.full_like(x, 1e-8) for x in (weights, trans, start)]
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[:-1][inside].astype(int), y[1:][inside].astype(int)), 1)
    for _ in range(steps):
        unary = weights[own_at].sum(axis=1)
        unary[1:] += np.where(inside, weights[before_at], 0)
        unary[:-1] += np.where(inside, weights[after_at], 0)
        p, forward, backward = chain(unary, first, trans, start)
        gap = (p - y) / len(y)
        g = np.bincount(own_at.ravel(), np.repeat(gap, own_at.shape[1]), TABLE)
        g += np.bincount(before_at, gap[1:] * inside, TABLE) + np.bincount(after_at, gap[:-1] * inside, TABLE) + l2 * weights
        e = np.stack([1 / (1 + np.exp(np.clip(unary, -30, 30))), 1 / (1 + np.exp(-np.clip(unary, -30, 30)))])
        pairs = forward[:, None, :-1] * np.exp(trans)[:, :, None] * (e * backward)[None, :, 1:]
        pairs = (pairs / pairs.sum(axis=(0, 1)))[:, :, inside].sum(axis=2)
        g_trans = (pairs - observed) / len(y) + l2 * trans
        g_start = np.array([(y - p)[first].sum(), (p - y)[first].sum()]) / len(y) + l2 * start
        for x, grad, seen in zip((weights, trans, start), (g, g_trans, g_start), state, strict=True):
            seen += grad * grad
            x -= rate * grad / np.sqrt(seen)
    return Field(weights, trans, start)


@dataclass(frozen=True)
class Model:
    """A field and a logistic fit (bias and two slopes); without a field, the bias is the score."""

    field: Field | None
    logistic: np.ndarray


def _top_two(p: np.ndarray) -> tuple[float, float]:
    """Log-odds of the two largest probabilities; -9 for missing ones."""
    best = np.sort(p[np.argpartition(p, -2)[-2:]] if len(p) > 2 else p)[::-1]
    odds = [float(np.clip(np.log((x + 1e-12) / (1 - x + 1e-12)), -9, 9)) for x in best] + [-9.0, -9.0]
    return odds[0], odds[1]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    z, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-z @ w))
        w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
    return w


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of both kinds that have a word, summed by batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts[int(y)].update({plain(w) for w in set((text.as_py() or "").split())})
        words = [w for w in counts[0].keys() | counts[1].keys() if w]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in counts]], names=["word", "clean", "toxic"])


def _sampled(text: str, share: float) -> bool:
    return zlib.crc32(text.encode()) % 10_007 < share * 10_007


def _sampled_words(share: dict[int, float]):
    """The words of the toxic documents from which segments are cut: no other word's support is asked for."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: set[str] = set()
            for y, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                if y and _sampled(text, share[1]):
                    words.update(map(plain, set(text.split())))
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], names=["word"])

    return read


def _segments(support: dict[str, int], share: dict[int, float]):
    """Tagged segments of sampled documents, chosen by a checksum of the text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tags = [], []
            for y, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                seed = zlib.crc32(text.encode())
                tokens = text.split()
                if not tokens or not _sampled(text, share[int(y)]):
                    continue
                rng = np.random.default_rng(seed)
                known = [support.get(plain(w), 0) if y else 0 for w in tokens]
                least = max(2, max(known) / 4)
                tag = [int(k >= least) for k in known]
                hits = np.flatnonzero(tag)
                starts = [max(0, int(h) - int(rng.integers(SEGMENT))) for h in (rng.choice(hits, SEGMENTS) if len(hits) else rng.integers(len(tokens), size=SEGMENTS))]
                for at in sorted(set(starts)):
                    words.append(tokens[at : at + SEGMENT])
                    tags.append(tag[at : at + SEGMENT])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int32()))], names=["words", "tags"])

    return cut


def train(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS, max_segments_of: int = MAX_SEGMENTS_OF) -> Model:
    rows = materialize(labelled(docs, labels, "toxic", 5, HELD_OUT, max_documents).select("y", "text"))
    kinds = dict(rows.groupBy("y").count().collect())
    clean, toxic = kinds.get(0.0, 0), kinds.get(1.0, 0)
    if not clean or not toxic:
        return Model(None, np.array([toxic / max(1, clean + toxic)]))
    counts = rows.mapInArrow(_word_counts, "word string, clean bigint, toxic bigint").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.ln((F.col("toxic") + 0.5) / (toxic + 1)) - F.ln((F.col("clean") + 0.5) / (clean + 1))
    share = {0: max_segments_of / clean, 1: max_segments_of / toxic}
    chosen = counts.where((F.col("toxic") >= 2) & (odds > 3)).join(rows.mapInArrow(_sampled_words(share), "word string").distinct(), "word", "left_semi")
    support = dict(chosen.select("word", "toxic").collect())
    cut = rows.mapInArrow(_segments(support, share), "words array<string>, tags array<int>").collect()
    cut.sort()
    field = fit_field([r.words for r in cut], [r.tags for r in cut])
    ratio = min(1.0, 4 * max_segments_of / (clean + toxic))
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(10_007)) < ratio * 10_007)
    tops = some.mapInArrow(_tops(field), "y double, a double, b double").collect()
    x, y = np.array([(r.a, r.b) for r in tops]).reshape(-1, 2), np.array([r.y for r in tops])
    return Model(field, _logistic(x, y))


def _grouped(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in groups of about TOKENS tokens."""
    group, size = [], 0
    for value in texts:
        group.append(value.as_py() or "")
        size += len(group[-1]) // 6
        if size >= TOKENS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _tops(field: Field):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            tops = [_top_two(p) for group in _grouped(batch.column(1)) for p in tagger.probabilities([t.split() for t in group])]
            a, b = zip(*tops) if tops else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.float64()), pa.array(b, pa.float64())], names=["y", "a", "b"])

    return scored


def spans(text: str, p: np.ndarray, threshold: float = THRESHOLD) -> list[dict]:
    """Runs of tokens of at least ``threshold``: character offsets and the largest probability."""
    if not (p >= threshold).any():
        return []
    found: list[dict] = []
    last = -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        if p[i] >= threshold:
            if last == i - 1:
                found[-1] |= {"stop": m.end(), "score": max(found[-1]["score"], float(p[i]))}
            else:
                found.append({"start": m.start(), "stop": m.end(), "score": float(p[i])})
            last = i
    return found


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, spans): spans as character offsets with the largest probability of their tokens."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model.field) if model.field else None
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            scores, found = [], []
            for group in _grouped(batch.column(1)):
                if tagger is None:
                    scores += [float(model.logistic[0])] * len(group)
                    found += [[]] * len(group)
                    continue
                for value, p in zip(group, tagger.probabilities([t.split() for t in group]), strict=True):
                    a, b = _top_two(p)
                    scores.append(float(1 / (1 + np.exp(-(model.logistic @ (1.0, a, b))))))
                    found.append(spans(value, p))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], names=[key, "score", "spans"])

    schema = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])
    return docs.select(docs[key], docs[text].cast("string")).mapInArrow(scored, schema)


@query("op6_toxicity")
def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and offending spans of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == HELD_OUT, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "spans")
