"""Quality classifier: ridge regression on random Fourier features of document statistics, with isotonic calibration.

cos(w.z + b) features with w from a normal distribution approximate a Gaussian kernel over the standardised statistics (Rahimi and Recht, 2007).
Labelled rows give the normal equations: every task sums its own outer products, and only the PARTS sums of (FEATURES + 1)^2 numbers reach the driver.
Half of the labelled rows held back from the fit (remainder 3 of the id's checksum) calibrate: a pool-adjacent-violators fit over BINS score bins.

``max_labels`` bounds the labelled rows used for fitting (a documented sample by the id's hash); scoring reads every whole text.
Inputs of a score are the statistics of the text alone.

Defined cases: a null text counts as empty and is scored like any text; label rows with a null id or label are ignored; an id labelled more than once
takes its least label; without any labelled row every score is 0.5 and the filter keeps everything; an empty table gives no rows; very long texts are read whole;
further columns are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import id_remainder, query, table
from rowmill.llm.statistics import NAMES, statistics
from rowmill.session import materialize

FEATURES = 512
GAMMA = 0.02
RIDGE = 0.1
BINS = 1024
PARTS = 16
MAX_LABELS = 200_000
THRESHOLD = 0.7
HELD_OUT = 2
CALIBRATE = 3
SEED = 20
GROUP = 512


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return expand(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated; a hundredth of the raw score keeps the order inside the steps of the calibration."""
        raw = np.clip(self.raw(stats), 0.0, 1.0)
        return 0.99 * np.interp(raw, self.knots, self.values) + 0.01 * raw


def expand(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant, (rows, FEATURES + 1)."""
    z = np.clip((stats - mean) / scale, -8.0, 8.0)
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(z.shape[1], FEATURES)) * np.sqrt(2 * GAMMA)
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(z), 1))], axis=1)


def isotonic(scores: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit to sums / counts at ascending scores."""
    blocks: list[list[float]] = []
    for s, c in zip(sums, counts, strict=True):
        blocks.append([float(s), float(c), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return np.concatenate([np.full(n, s / c) for s, c, n in blocks])


def labelled(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, max_labels: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(fold, y, text) of at most about ``max_labels`` labelled documents outside the held-out remainder.

    The chosen labels are a table of bounded size, so they are broadcast and no text is shuffled.
    """
    ids = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (id_remainder(F.col(key), divisor) != held_out))
    ids = ids.groupBy(F.col(key).alias("_id")).agg(F.min(label).cast("double").alias("y"))
    n = ids.count()
    share = min(1.0, max_labels / max(1, n))
    chosen = ids.where(F.shiftrightunsigned(F.xxhash64("_id"), 2) < int(share * 2**62))
    if n and share < 1 and not chosen.head(1):
        raise ValueError(f"none of {n} labelled ids falls into the sample of about {max_labels}")
    rows = docs.select(docs[key].alias("_key"), docs[text].cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).select(id_remainder(F.col("_key"), divisor).alias("fold"), "y", "text")


def _stats_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = [statistics(v.as_py() or "") for v in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(stats, pa.list_(pa.float64()))], names=["fold", "y", "stats"])


def _sums(mean: np.ndarray, scale: np.ndarray):
    """Sum of one task: the matrix of the normal equations, with the right side as a further column."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x, y = _matrix(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(y), 4096):
                p = expand(x[at : at + 4096], mean, scale)
                total[:, :-1] += p.T @ p
                total[:, -1] += p.T @ y[at : at + 4096]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return summed


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model | None:
    """The model, or None if there is no labelled document."""
    rows = labelled(docs, labels, "quality", 4, HELD_OUT, max_labels)
    rows = materialize(rows.mapInArrow(_stats_rows, "fold int, y double, stats array<double>"))
    at = [F.col("stats")[i] for i in range(len(NAMES))]
    moments = rows.agg(F.count(F.lit(1)), F.sum(F.when(F.col("fold") == CALIBRATE, 1)), *map(F.avg, at), *map(F.stddev_pop, at)).first()
    if not moments[0]:
        return None
    mean, scale = np.array(moments[2 : 2 + len(NAMES)]), np.array(moments[2 + len(NAMES) :])
    scale = np.where(scale < 1e-9, 1.0, scale)
    halves = 0 < (moments[1] or 0) < moments[0]
    fit = rows.where(F.col("fold") != CALIBRATE) if halves else rows
    parts = fit.select("y", "stats").coalesce(PARTS).mapInArrow(_sums(mean, scale), "sums binary").collect()
    total = sum(np.frombuffer(r[0]).reshape(FEATURES + 1, FEATURES + 2) for r in parts)
    weights = np.linalg.solve(total[:, :-1] + RIDGE * np.eye(FEATURES + 1), total[:, -1])
    plain = Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.concatenate([np.clip(plain.raw(_matrix(batch.column(1).slice(k, 4096))), 0, 1) for k in range(0, batch.num_rows, 4096)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([pa.array(np.round(raw * BINS).astype("i4")), batch.column(0)], names=["bin", "y"])

    held = rows.where(F.col("fold") == CALIBRATE) if halves else rows
    bins = held.select("y", "stats").mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.sum("y"), F.count(F.lit(1))).orderBy("bin").collect()
    knots = np.array([r[0] / BINS for r in bins])
    values = isotonic(knots, np.array([r[1] for r in bins]), np.array([r[2] for r in bins]))
    return Model(mean, scale, weights, knots, values)


def _scored(model: Model | None, texts: pa.Array) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    scores = []
    for at in range(0, len(texts), GROUP):
        stats = np.array([statistics(v.as_py() or "") for v in texts.slice(at, GROUP)])
        scores.append(model.score(stats))
    return np.concatenate(scores) if scores else np.zeros(0)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score), a row for each row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scored(model, batch.column(1)))], names=[key, "score"])

    schema = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType())])
    return docs.select(docs[key], docs[text].cast("string")).mapInArrow(scored, schema)


def keep_good(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores at least ``threshold``, as they are."""
    if model is None:
        return docs
    position = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scored(model, batch.column(position)) >= threshold))

    return docs.mapInArrow(kept, docs.schema)


@query("op5_quality_classifier")
def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == HELD_OUT, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
