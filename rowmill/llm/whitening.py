"""Whitening of embeddings: directions from a blockwise QR, a Householder bidiagonal form, dqds and twisted factorisations.

1. Entries c become whole numbers x = floor(SCALE * c) + OFFSET. Tasks sum them; n and the sums S are exact.
2. Every task reduces its centred rows (n * x - S, exact, over n) block by block to one triangular R; groups of FAN such R are stacked and reduced again on
   the executors until FAN or fewer are left. Each is d x d, whatever the number of rows, so what reaches the driver is bounded by the dimension.
3. The last R becomes bidiagonal by Householder reflections. dqds finds its squared singular values to high relative accuracy (Fernando and Parlett, 1994).
   For each wanted one, the twisted factorisation of B'B - s with the least pivot gives the vector directly (Dhillon, 1997); vectors of values that
   lie close together are made orthogonal. The reflections carry the vectors back.
4. A pass writes the whitened rows; the covariance of the whitened rows, centred block by block, shows how far they are from white.

Eigenvalues of the covariance are squared singular values over n. The sign of a direction makes its largest entry positive.

Defined cases: rows whose vector is null, or empty, or holds a null or non-finite entry are left out; of vectors of different lengths only those of the commonest
length count (the longer one at a tie), the others are left out; x is held within +-2**40; a null key is carried on; repeated rows count and come out as often as
they came in; directions without variance (a singular value below max(d, 16) * 2**-52 of the largest) have no whitened form and give no row, so equal rows or a single
row give none; equal eigenvalues share a space and any orthonormal basis of it; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table
from rowmill.session import forget, materialize

SCALE = 1024
OFFSET = 100_000
LIMIT = 1 << 40
COMPONENTS = 8
BLOCK = 2048
FAN = 32
EPS = 2.0**-52
CLOSE = 1e-4


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return centred(x, self.n, self.sums)

    def apply(self, rows: np.ndarray) -> np.ndarray:
        """Centred rows to whitened rows."""
        return rows @ self.directions / np.sqrt(self.values)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(x - S / n as doubles, the exact sum of (n * x - S)^2 of each row as Python or 64-bit integers)."""
    if not len(x):
        return np.zeros(x.shape), np.zeros(0, np.int64)
    exact = n * max(int(np.abs(x).max()), 1) + max(map(abs, sums)) < 1 << 62
    moved = n * x - np.array(sums, np.int64) if exact else n * x.astype(object) - np.array(sums, object)
    most = max(abs(int(moved.max())), abs(int(moved.min())))
    wide = moved if most * most * x.shape[1] < 1 << 62 else moved.astype(object)
    return (moved / n).astype(np.float64), (wide * wide).sum(axis=1)


def numbers(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows count, their x) of a list column."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fit = lengths == d
    flat = column.filter(pa.array(fit)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)  # nulls become nan
    whole = np.isfinite(values).all(axis=1)
    kept = np.flatnonzero(fit)[whole]
    return kept, (np.clip(np.floor(SCALE * values[whole]), -LIMIT, LIMIT) + OFFSET).astype(np.int64)


def _blocks(column: pa.Array, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(column), BLOCK):
        kept, x = numbers(column.slice(at, BLOCK), d)
        yield kept + at, x


def _triangle(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): the diagonal and superdiagonal of U' r V for a square r, by Householder reflections from both sides."""
    m, d = np.array(r, np.float64), r.shape[1]
    v = np.eye(d)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            return None
        u = x.copy()
        u[0] += np.copysign(norm, x[0])
        return u / np.linalg.norm(u)

    for k in range(d):
        u = reflection(m[k:, k])
        if u is not None:
            m[k:, k:] -= 2 * np.outer(u, u @ m[k:, k:])
        if k + 2 < d:
            u = reflection(m[k, k + 1 :])
            if u is not None:
                m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ u, u)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, int]:
    """One differential step; the last value and the place of the first negative one (-1: none)."""
    nq, ne = [], []
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return nq, ne, d, i
        top = d + e[i]
        nq.append(top)
        if top == 0:  # a zero value: the rest is another matrix
            ne.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / top
            ne.append(e[i] * ratio)
            d = d * ratio - shift
    nq.append(d)
    return nq, ne, d, len(e) if d < 0 else -1


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix (a, b), falling."""
    found: list[float] = []
    work = [(list(map(float, a * a)), list(map(float, b * b)), 0.0)]
    while work:
        q, e, moved = work.pop()
        while q:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= (EPS / 4) ** 2 * (moved + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(moved + q[0])
                break
            # The least value of the last two rows and columns is near the least value of all, once these have come down.
            x, y, w = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            mean, half = (x + y) / 2, (x - y) / 2
            shift = max(0.0, (x * y - w) / (mean + np.hypot(half, np.sqrt(w)))) if mean > 0 else 0.0
            for attempt in range(5):
                nq, ne, last, bad = _qd_step(q, e, shift)
                if bad < 0:
                    break
                shift = max(0.0, shift + last) if bad == len(e) and attempt < 2 else shift / 4 if attempt < 3 else 0.0
            q, e, moved = nq, ne, moved + shift
    return np.array(sorted(found, reverse=True))


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of B'B for its eigenvalue ``value``, from the twisted factorisation with the least pivot."""
    d, tiny = len(a), 1e-290 + EPS * EPS * value
    q, e, off = a * a, b * b, a[:-1] * b
    s, down = np.empty(d), np.empty(max(0, d - 1))
    s[0] = -value
    for i in range(d - 1):
        pivot = q[i] + s[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        down[i] = off[i] / pivot
        s[i + 1] = e[i] * s[i] / pivot - value
    p, up = np.empty(d), np.empty(max(0, d - 1))
    p[-1] = q[-1] - value
    for i in range(d - 2, -1, -1):
        pivot = e[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        up[i] = off[i] / pivot
        p[i] = p[i + 1] * q[i] / pivot - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(d)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, d - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def singular(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(all squared singular values, falling; the first ``wanted`` right singular vectors as columns) of a square r."""
    largest = np.abs(r).max()
    if largest == 0:
        return np.zeros(len(r)), np.zeros((len(r), 0))
    a, b, v = bidiagonal(r / largest)
    values = dqds(a, b)
    gram = np.diag(a * a + np.append(0.0, b * b)) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    vectors: list[np.ndarray] = []
    rng = np.random.default_rng(0)
    for i in range(min(wanted, len(values))):
        if values[i] <= (max(len(r), 16) * EPS) ** 2 * values[0]:
            break
        near = [vectors[j] for j in range(i) if values[j] - values[i] <= CLOSE * values[j]]
        z = twisted(a, b, values[i])
        for _ in range(8 if near else 0):
            for _ in range(2):
                for other in near:
                    z = z - (other @ z) * other
            norm = np.linalg.norm(z)
            if norm > 0.5 and np.linalg.norm(gram @ z / norm - values[i] * z / norm) <= 64 * EPS * values[0]:
                break
            # The same vector as before, or turned too far: inverse iteration inside what the others leave.
            if norm < 0.5:
                z = rng.normal(size=len(a))
                for other in near:
                    z = z - (other @ z) * other
            z = np.linalg.solve(gram - values[i] * (1 + 4 * EPS) * np.eye(len(a)) + EPS * values[0] * np.eye(len(a)), z)
            z /= np.linalg.norm(z)
        vectors.append(z / np.linalg.norm(z))
    return values * largest**2, v @ np.array(vectors).T


def _reduced(parts: DataFrame, fold: Callable[[list[bytes]], bytes]) -> list[bytes]:
    """At most FAN rows of (part, data), after folding groups of FAN on the executors as often as needed."""

    def folded(group: pa.Table) -> pa.Table:
        data = fold([v.as_py() for v in group.column("data")])
        return pa.table({"part": pa.array([group.column("part")[0].as_py() // FAN], pa.int32()), "data": pa.array([data], pa.binary())})

    stored = materialize(parts)
    while stored.count() > FAN:
        after = materialize(stored.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(folded, "part int, data binary"))
        forget(stored)
        stored = after
    data = [r.data for r in stored.collect()]
    forget(stored)
    return data


def _part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _row(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_part()], pa.int32()), pa.array([data], pa.binary())], names=["part", "data"])


def _triangles(vectors: DataFrame, d: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    def fold(data: list[bytes]) -> bytes:
        return _triangle([np.frombuffer(x).reshape(-1, d) for x in data]).tobytes()

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for _, x in _blocks(batch.column(0), d):
                r = _triangle([r, centred(x, n, sums)[0]])
        if len(r):
            yield _row(r.tobytes())

    r = np.frombuffer(fold(_reduced(vectors.mapInArrow(triangles, "part int, data binary"), fold))).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all vectors that count; None if there are none."""
    entries = df[vector].cast("array<double>")
    vectors = df.select(entries.alias("v")).where("size(v) > 0")
    whole = vectors.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if lengths is None:
        return None
    d, n = lengths

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = [0] * d
            for _, x in _blocks(batch.column(0), d):
                total = [t + int(s) for t, s in zip(total, x.sum(axis=0))]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total, pa.int64())], names=["i", "s"])

    rows = vectors.mapInArrow(summed, "i int, s bigint").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    sums = tuple(int(r.s) for r in rows)
    squares, directions = singular(_triangles(vectors, d, n, sums), components)
    if directions.size:
        directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    return Whitening(n, sums, squares[: directions.shape[1]] / n, directions, float(squares.sum() / n))


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest entry, in size, of the covariance of the whitened rows minus the identity; each block is centred before it is multiplied."""
    d, k = len(model.sums), len(model.values)

    def fold(data: list[bytes]) -> bytes:
        n, mean, cross = 0.0, np.zeros(k), np.zeros((k, k))
        for x in data:
            part = np.frombuffer(x)
            m, other, more = part[0], part[1 : k + 1], part[k + 1 :].reshape(k, k)
            gap = other - mean
            cross = cross + more + np.outer(gap, gap) * (n * m / (n + m))
            mean, n = mean + gap * (m / (n + m)), n + m
        return np.concatenate([[n], mean, cross.ravel()]).tobytes()

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data: list[bytes] = []
        for batch in batches:
            for _, x in _blocks(batch.column(0), d):
                if len(x):
                    w = model.apply(model.centred(x)[0])
                    mean = w.mean(axis=0)
                    data = [fold([*data, np.concatenate([[len(w)], mean, ((w - mean).T @ (w - mean)).ravel()]).tobytes()])]
        if data:
            yield _row(data[0])

    vectors = df.select(df[vector].cast("array<double>").alias("v"))
    whole = np.frombuffer(fold(_reduced(vectors.mapInArrow(moments, "part int, data binary"), fold)))
    return float(np.abs(whole[k + 1 :].reshape(k, k) / whole[0] - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component from 1, deviation, whitened): a row for each vector that counts and each direction; deviation is the exact sum of (n * x - S)^2."""
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL("component int, deviation decimal(38,0), whitened double")])
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    d, k = len(model.sums), len(model.values)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kept, x in _blocks(batch.column(1), d):
                rows, deviation = model.centred(x)
                keys = batch.column(0).take(pa.array(np.repeat(kept, k)))
                exact = deviation.astype(object) if deviation.dtype != object else deviation
                wide = pa.array([int(v) for v in np.repeat(exact, k)], pa.int64()).cast(pa.decimal128(38, 0)) if all(v < 1 << 62 for v in exact) else _decimals(np.repeat(exact, k))
                numbered = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept)))
                yield pa.RecordBatch.from_arrays([keys, numbered, wide, pa.array(model.apply(rows).ravel())], names=[key, "component", "deviation", "whitened"])

    return df.select(df[key], df[vector].cast("array<double>").alias("v" if key != "v" else "v_")).mapInArrow(whitened, schema)


def _decimals(values: np.ndarray) -> pa.Array:
    from decimal import Context, Decimal

    exact = Context(prec=60)
    return pa.array([exact.create_decimal(Decimal(int(v))) for v in values], pa.decimal128(38, 0))


@query("op13_embedding_whitening")
def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened rows of all embeddings."""
    rows = table(spark, sf_dir, "embeddings")
    model = fit(rows)
    out = whiten(rows, model)
    if model is None or not len(model.values):
        n, explained, error = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("double")
    else:
        n, error = F.lit(model.n).cast("bigint"), F.lit(identity_error(rows, model))
        explained = F.element_at(F.array(*[F.lit(float(v / model.total)) for v in model.values]), F.col("component"))
    return out.select("vec_id", "component", n.alias("n"), F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened",
                      explained.alias("explained"), error.alias("identity_error"))
