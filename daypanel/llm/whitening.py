"""Principal components of embeddings, kept up to date one vector at a time, and embeddings whitened by them.

1. Entries become whole units of 1 / ``UNIT``. The *fit list* is every distinct vector once.
2. Each partition of the fit list holds a number of vectors, their mean and the spectral decomposition of their scatter
   matrix. A vector is a centred rank-one update of it: in the eigenbasis the new scatter is a diagonal plus a rank-one
   matrix. Entries that do not matter and equal eigenvalues are deflated; the roots of the secular equation are the new
   eigenvalues; eigenvectors come from the Loewner formula, so they stay orthogonal.
3. Two spectra are combined in the same way: one rank-one update for each eigenpair of the second, one for the distance
   of the means. Spectra are combined in a tree of tasks, ``FAN`` at a time.
4. The basis that comes out is refined by Rayleigh-Ritz steps over the fit list: each partition projects its centred
   vectors on the basis, the small matrices are added up in the same tree, and their eigenvectors turn the basis. The last
   step also measures how far the covariance of the whitened vectors is from the identity.

The driver holds one spectrum: the square of the number of dimensions, whatever the number of vectors.

Dropped are null vectors and those with null or non-finite entries; also entries of 2^53 units or more, which are no exact
doubles any more, and vectors whose number of entries is not that of most (of the longer, if two are as frequent).
Repeated rows each get a result, and count once for the fit. No remaining rows give no result. Components without variance
have a null ``whitened`` and no part in ``identity_error``, which is null if there is no other; ``explained`` is null if no
component has variance. A ``deviation`` of 2^63 or more is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

UNIT = 256
COMPONENTS = 4
FAN = 8
#: Rayleigh-Ritz steps end when no entry beside the diagonal is above this share of the largest eigenvalue.
SETTLED = 1e-15
MOST_STEPS = 4
_EPS = np.finfo(float).eps
_SPECTRUM = "id long, n long, mean array<double>, high array<long>, low array<long>, most long, values array<double>, vectors array<double>"


def secular_roots(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``roots - poles`` of 1 + sum(w / (d - x)) for ascending, distinct d and positive w: one row for each root.

    Each root is sought from the nearer of its two poles, so that the small differences are exact. The step takes the two
    poles as they are and the rest as constant; where it leaves the bracket, the bracket is halved.
    """
    m = len(d)
    gap = np.append(np.diff(d), w.sum())
    i = np.arange(m)
    middle = d + gap / 2
    with np.errstate(divide="ignore"):
        at_middle = 1 + (w / (d - middle[:, None])).sum(1)
    origin = np.where((at_middle >= 0) | (i == m - 1), i, np.minimum(i + 1, m - 1))
    delta = d - d[origin][:, None]
    low = np.where(origin == i, 0.0, -gap / 2)
    high = np.where(origin == i, np.where(i == m - 1, gap, gap / 2), 0.0)
    x = (low + high) / 2
    right, last = np.minimum(i + 1, m - 1), i == m - 1
    left, busy = np.tri(m, dtype=bool), i
    for _ in range(80):
        away = delta[busy] - x[busy, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            term = w / away
            f = 1 + term.sum(1)
            settled = np.abs(f) <= 4 * _EPS * (1 + np.abs(term).sum(1))  # all that rounding leaves of f
            term /= away
            slope = term.sum(1)
            psi = np.einsum("ij,ij->i", term, left[busy])
            place = np.arange(len(busy))
            a1, a2, end = away[place, busy], away[place, right[busy]], last[busy]
            c = f - a1 * psi - np.where(end, 0.0, a2 * (slope - psi))
            a, b = (a1 + a2) * f - a1 * a2 * slope, a1 * a2 * f
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(end, a1 + a1 * a1 * psi / c, step)
        old = x[busy]
        high[busy] = np.where(f > 0, old, high[busy])
        low[busy] = np.where(f > 0, low[busy], old)
        new = old + step
        new = np.where(np.isfinite(new) & (new > low[busy]) & (new < high[busy]), new, (low[busy] + high[busy]) / 2)
        x[busy] = np.where(settled, old, new)
        busy = busy[~settled & (np.abs(new - old) > 4 * _EPS * np.abs(new))]
        if not len(busy):
            break
    return x[:, None] - delta


def rank_one(values: np.ndarray, vectors: np.ndarray, weight: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors of ``vectors diag(values) vectors' + weight v v'``, ``weight`` 0 or more."""
    z = vectors.T @ v
    total = weight * float(z @ z)
    if not total > 0:
        return values, vectors
    tolerance = 8 * _EPS * (max(float(values[-1]), 0.0) + total)
    # Equal eigenvalues: their eigenvectors are turned so that v meets only one of them.
    runs = np.flatnonzero(np.diff(values) > tolerance) + 1
    if len(runs) + 1 < len(values):
        vectors, z = vectors.copy(), z.copy()
        for low, high in zip(np.append(0, runs), np.append(runs, len(values))):
            norm = float(np.linalg.norm(z[low:high]))
            if high - low > 1 and norm > 0:
                mirror = z[low:high].copy()
                mirror[-1] += np.copysign(norm, mirror[-1])
                mirror /= np.linalg.norm(mirror)
                vectors[:, low:high] -= 2 * np.outer(vectors[:, low:high] @ mirror, mirror)
                z[low:high] = 0
                z[high - 1] = -np.copysign(norm, mirror[-1])
    w = weight * z * z
    live = np.flatnonzero(np.sqrt(w * total) > tolerance)
    if not len(live):
        return values, vectors
    d, z = values[live], z[live]
    if len(live) == 1:
        away = np.array([[w[live[0]]]])
    else:
        away = secular_roots(d, w[live])
    m = len(d)
    i, j = np.arange(m)[:, None], np.arange(m)
    below = np.where(i < j, d[:, None], np.append(d[1:], 0.0)[:, None]) - d
    below[-1] = 1.0
    with np.errstate(divide="ignore", invalid="ignore"):
        exact = np.sqrt(np.abs(np.prod(away / below, axis=0))) * np.where(z < 0, -1.0, 1.0)
        turn = exact / -away
    turn = np.where(np.isfinite(turn), turn, 0.0)
    turn = (turn / np.linalg.norm(turn, axis=1, keepdims=True)).T
    new, turned = values.copy(), vectors.copy()
    new[live] = d + away[j, j]
    turned[:, live] = vectors[:, live] @ turn
    order = np.argsort(new, kind="stable")
    return new[order], turned[:, order]


class Spectrum:
    """Number, mean, and eigenvalues and eigenvectors of the scatter matrix of some vectors; exact sums beside them."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)
        self.high, self.low, self.most = np.zeros(size, np.int64), np.zeros(size, np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        self.high += (rows >> 26).sum(0)
        self.low += (rows & ((1 << 26) - 1)).sum(0)
        self.most = max(self.most, int(np.abs(rows).max(initial=0)))
        for x in rows.astype(float):
            away = x - self.mean
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), away)
            self.n += 1
            self.mean = self.mean + away / self.n

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            self.values, self.vectors = rank_one(self.values, self.vectors, max(float(value), 0.0), vector)
        both, away = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / both, away)
        self.mean = self.mean + away * (other.n / both)
        self.n, self.most = both, max(self.most, other.most)
        self.high, self.low = self.high + other.high, self.low + other.low

    def row(self, at: int) -> pd.DataFrame:
        cells = [at, self.n, self.mean, self.high, self.low, self.most, self.values, self.vectors.ravel()]
        names = [field.split()[0] for field in _SPECTRUM.split(", ")]
        return pd.DataFrame({name: [cell] for name, cell in zip(names, cells)})

    @classmethod
    def read(cls, row) -> Spectrum:
        out = cls(len(row.mean))
        out.n, out.most = int(row.n), int(row.most)
        out.mean, out.values = np.array(row.mean, float), np.array(row.values, float)
        out.vectors = np.array(row.vectors, float).reshape(len(out.mean), -1)
        out.high, out.low = np.array(row.high, np.int64), np.array(row.low, np.int64)
        return out

    @property
    def sums(self) -> list[int]:
        return [(int(h) << 26) + int(low) for h, low in zip(self.high, self.low)]


def units(embeddings: DataFrame) -> DataFrame:
    """vec_id and ``x``, the entries in whole units, of the rows that are not dropped."""
    most = float(1 << 53)
    x = F.transform("embedding", lambda c: c.cast("double") * F.lit(float(UNIT)))
    fine = F.forall("x", lambda c: F.coalesce((c > F.lit(-most)) & (c < F.lit(most)), F.lit(False)))
    rows = embeddings.select("vec_id", x.alias("x")).filter(F.col("x").isNotNull()).filter(fine & (F.size("x") > 0))
    rows = staged(rows.select("vec_id", F.transform("x", lambda c: F.floor(c).cast("long")).alias("x")), "white-units")
    lengths = rows.groupBy(F.size("x").alias("length")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size("x") == F.lit(first["length"] if first else 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _folded(rows: DataFrame, merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> pd.DataFrame | None:
    """The one row that ``merge`` makes of all rows, ``FAN`` a task, level by level. Ids are numbers of partitions."""
    rows = staged(rows, "white-parts")
    left = rows.count()
    while left > 1:
        left = -(-left // FAN)
        dealt = rows.withColumn("id", F.pmod("id", F.lit(left)))
        rows = staged(dealt.groupBy("id").applyInPandas(lambda part: merge(part), schema), "white-parts")
        left = rows.count()
    return rows.toPandas() if left else None


def spectrum(fit: DataFrame, size: int) -> Spectrum | None:
    """The spectrum of the vectors ``x`` of ``fit``."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = Spectrum(size)
        for batch in batches:
            own.add(_matrix(batch.column("x"), size))
        if own.n:
            context = TaskContext.get()
            yield pa.RecordBatch.from_pandas(own.row(context.partitionId() if context else 0), preserve_index=False)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        rows = [Spectrum.read(row) for row in part.itertuples()]
        for other in rows[1:]:
            rows[0].combine(other)
        return rows[0].row(int(part["id"].iloc[0]))

    found = _folded(fit.select("x").mapInArrow(local, _SPECTRUM), merge, _SPECTRUM)
    return None if found is None else Spectrum.read(next(found.itertuples()))


def _projected(fit: DataFrame, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """basis' V basis for the covariance V of the fit list: centred, projected and multiplied partition by partition."""
    size, wide = basis.shape
    schema = "id long, n long, cells array<double>"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cells, n = np.zeros((wide, wide)), 0
        for batch in batches:
            y = (_matrix(batch.column("x"), size) - mean) @ basis
            cells += y.T @ y
            n += len(y)
        if n:
            context = TaskContext.get()
            row = {"id": [context.partitionId() if context else 0], "n": [n], "cells": [cells.ravel()]}
            yield pa.RecordBatch.from_pandas(pd.DataFrame(row), preserve_index=False)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": [part["id"].iloc[0]], "n": [part["n"].sum()], "cells": [np.sum(np.stack(part["cells"]), axis=0)]})

    row = next(_folded(fit.select("x").mapInArrow(local, schema), merge, schema).itertuples())
    return np.array(row.cells, float).reshape(wide, wide) / row.n


def components(fit: DataFrame, size: int) -> dict | None:
    """n, sums (whole numbers), mean, values (falling), vectors, trace, most, and identity_error of the fit list."""
    whole = spectrum(fit, size)
    if whole is None:
        return None
    mean = np.array([s / whole.n for s in whole.sums])
    basis = np.linalg.qr(whole.vectors[:, ::-1])[0]
    for _ in range(MOST_STEPS):
        ritz = _projected(fit, mean, basis)
        ritz = (ritz + ritz.T) / 2
        beside = np.abs(ritz - np.diag(np.diag(ritz))).max()
        values, turn = np.linalg.eigh(ritz)
        values, basis = values[::-1], np.linalg.qr(basis @ turn[:, ::-1])[0]
        if beside <= SETTLED * max(float(values[0]), 0.0):
            break
    # Either sign is right; the largest entry of a vector is made positive, so reruns agree.
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(size)] < 0, -1.0, 1.0)
    shown = min(COMPONENTS, size)
    alive = values[:shown] > 8 * size * _EPS * max(float(values[0]), 0.0)
    error = None
    if alive.any():
        scaled = basis[:, :shown][:, alive] / np.sqrt(values[:shown][alive])
        error = float(np.abs(_projected(fit, mean, scaled) - np.eye(int(alive.sum()))).max())
    return {
        "n": whole.n, "sums": whole.sums, "mean": mean, "values": values[:shown], "vectors": basis[:, :shown],
        "alive": alive, "trace": float(np.trace(ritz)), "most": whole.most, "identity_error": error,
    }


def deviations(rows: np.ndarray, n: int, sums: list[int], most: int) -> list[int | None]:
    """sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    if len(sums) * (2 * n * most) ** 2 < 1 << 63:
        away = rows * n - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    away = rows.astype(object) * n - np.array(sums, object)
    return [int(v) if v < 1 << 63 else None for v in (away * away).sum(1)]


def whiten(embeddings: DataFrame) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of each remaining row."""
    rows = units(embeddings)
    fields = [
        embeddings.schema["vec_id"],
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
    schema = T.StructType(fields)
    first = rows.select(F.size("x").alias("size")).first()
    if first is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    size = int(first["size"])
    model = components(staged(rows.select("x").distinct(), "white-fit"), size)
    alive, values = model["alive"], np.where(model["alive"], model["values"], 1.0)
    scaled = model["vectors"] / np.sqrt(values)
    explained = [float(v) / model["trace"] if model["trace"] > 0 else None for v in model["values"]]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = scaled.shape[1]
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            y = (x - model["mean"]) @ scaled
            dead = np.broadcast_to(~alive, y.shape).ravel()
            columns = [
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), shown))),
                pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * shown, model["n"])),
                pa.array(deviations(x, model["n"], model["sums"], model["most"]), pa.int64()).take(
                    pa.array(np.repeat(np.arange(len(x)), shown))
                ),
                pa.array(y.ravel(), mask=dead),
                pa.array(explained * len(x), pa.float64()),
                pa.array([model["identity_error"]] * (len(x) * shown), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.select("vec_id", "x").mapInArrow(score, schema)


def brute_force(vectors: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, falling eigenvalues and eigenvectors of distinct vectors by a dense solver, for tests."""
    fit = np.array(sorted(set(map(tuple, vectors))), float)
    away = fit - fit.mean(0)
    values, found = np.linalg.eigh(away.T @ away / len(fit))
    return fit.mean(0), values[::-1], found[:, ::-1]
