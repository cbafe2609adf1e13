"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps the spectrum of its vectors' scatter matrix: a new vector, centred on the running mean, changes the
matrix by rank one, and the new eigenvalues are the roots of a secular equation. Entries that cannot move an eigenvalue
are deflated first: tiny ones are dropped, equal poles are rotated into one. The vectors of a partition are dealt to a few independent
lanes, so that numpy solves the equations of all lanes at once. Spectra are combined by successive rank-one updates, one for each eigenpair of the
other spectrum and one for the distance of the means, a few spectra a group and level, until one is left. That basis is
made orthonormal, and one more pass over all vectors projects their exactly centred values on it: the eigenvectors of the projected
covariance (Rayleigh-Ritz in the whole space) are the components to double precision. A last pass measures the covariance of the whitened
values.

Passes send one spectrum or one d x d matrix a partition; levels of ``fan`` rows reduce them, so neither the driver nor a task holds
more than ``fan`` of them. The driver gets one spectrum, one matrix and the d sums. Nothing is cached; spectra are written tables.

Defined results: vectors that are null, empty, or hold null or non-finite entries take no part, nor do those of another length than the
most common one (the longer of equally common ones); repeated rows and ids count and are returned each; null ids stay. Components stop at the dimension.
A component without variance (eigenvalue at most 1e-12 of the largest) has ``whitened`` null and no part in
``identity_error``; ``explained`` is null if nothing varies. ``deviation`` is exact, and null where it does not fit a
long. No usable vector gives no rows. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import shared_folder, stored

_TINY = 1e-14
_LANES, _LANE_ROWS = 8, 256


# -- rank-one updates of stacked spectra: values (lanes, d) ascending, vectors (lanes, d, d) in columns --------------

def _rotate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, scale: np.ndarray) -> None:
    """Deflate equal poles: turn each pair of neighbouring eigenvectors so that only the upper one meets the update."""
    close = np.diff(values, axis=1) <= _TINY * scale
    for i in np.nonzero(close.any(0))[0]:
        lanes = np.nonzero(close[:, i] & (z[:, i] != 0))[0]
        a, b = z[lanes, i], z[lanes, i + 1]
        r = np.hypot(a, b)
        c, s = (b / r)[:, None], (a / r)[:, None]
        low, high = vectors[lanes, :, i], vectors[lanes, :, i + 1]
        vectors[lanes, :, i], vectors[lanes, :, i + 1] = c * low - s * high, s * low + c * high
        z[lanes, i], z[lanes, i + 1] = 0.0, r


def secular_roots(poles: np.ndarray, weights: np.ndarray, rho: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(weights / (poles - x))``, one above each pole with a weight.

    Returns ``poles[j] - root[i]`` as (lanes, j, i), computed from the nearest pole, and the roots; a pole without
    weight is its own root. Every step fits a pole on either side with the sums' values and slopes and solves the
    resulting quadratic; a step that leaves its bracket halves the bracket.
    """
    on = weights > 0
    top = poles.max(1, keepdims=True) + (rho * weights.sum(1))[:, None]
    # The next pole with a weight, for the last one the bound of its root.
    later = np.where(on, poles, np.inf)[:, ::-1]
    after = np.minimum.accumulate(later, axis=1)[:, ::-1]
    after = np.concatenate([after[:, 1:], np.full_like(top, np.inf)], axis=1)
    last = ~np.isfinite(after)
    after = np.where(last, np.where(on, poles, 0) + (rho * weights.sum(1))[:, None], after)
    gap = np.where(on, after - poles, 0.0)
    weighted = (rho[:, None] * weights)[:, :, None]
    d = poles.shape[1]
    below = (np.arange(d)[:, None] <= np.arange(d)[None, :]).astype(float)  # pole j at or below root i
    above = 1.0 - below

    away = np.where(on, 0.0, np.inf)[:, :, None]  # poles without weight add nothing

    def parts(delta):
        inverse = 1.0 / delta
        term = weighted * inverse
        slope = term * inverse
        psi, dpsi = np.einsum("lji,ji->li", term, below), np.einsum("lji,ji->li", slope, below)
        return psi, dpsi, np.einsum("lji,ji->li", term, above), np.einsum("lji,ji->li", slope, above)

    # Origin: the nearer pole, by the sign in the middle of the gap.
    psi, _, phi, _ = parts(poles[:, :, None] - poles[:, None, :] - np.where(on, gap / 2, np.nan)[:, None, :] + away)
    upper = (1 + psi + phi < 0) & ~last
    origin = np.where(upper, after, poles)
    base = poles[:, :, None] - origin[:, None, :] + away
    # x is the root's distance from its origin.
    low = np.where(upper, -gap / 2, 0.0)
    high = np.where(upper, 0.0, np.where(last, gap, gap / 2))
    x = np.where(on, np.where(upper, -gap / 4, gap / 4), np.nan)
    far = np.where(last, np.inf, after - origin)  # position of the next pole
    near = poles - origin
    live = on & (gap > 0)
    for _ in range(steps):
        psi, dpsi, phi, dphi = parts(base - x[:, None, :])
        f = 1 + psi + phi
        low, high = np.where(f < 0, x, low), np.where(f >= 0, x, high)
        d1, d2 = near - x, far - x
        with np.errstate(all="ignore"):
            d2f = np.where(last, 1.0, d2)
            q, s = dpsi * d1 * d1, np.where(last, 0.0, dphi * d2f * d2f)
            c = 1 + psi - dpsi * d1 + np.where(last, 0.0, phi - dphi * d2f)
            # c + q / (near - y) + s / (far - y) = 0 for y.
            farf = np.where(last, near + 1.0, far)
            b = c * (near + farf) + q + s
            e = c * near * farf + q * farf + s * near
            root = np.sqrt(np.maximum(b * b - 4 * c * e, 0.0))
            two = np.where(b >= 0, (b + root) / (2 * c), (b - root) / (2 * c))
            one = np.where(b >= 0, 2 * e / (b + root), 2 * e / (b - root))
            y = np.where((one > low) & (one < high), one, two)
            y = np.where(last, near + q / np.where(c == 0, np.nan, c), y)
        inside = np.isfinite(y) & (y > low) & (y < high)
        y = np.where(inside, y, (low + high) / 2)
        # Settled where the sums cannot tell the value from 0, or the bracket has no room left.
        live = live & (np.abs(f) > 1e-14 * d * (1 + np.abs(psi) + np.abs(phi))) & \
            (high - low > 4e-16 * np.maximum(np.abs(high), np.abs(low)))
        x = np.where(live, y, x)
        if not live.any():
            break
    x = np.where(on, x, 0.0)
    origin = np.where(on, origin, poles)
    return poles[:, :, None] - origin[:, None, :] - x[:, None, :], origin + x


def rank_one(values: np.ndarray, vectors: np.ndarray, update: np.ndarray, rho: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectra of ``V diag(values) V' + rho * u u'`` for every lane; ``rho`` is not negative."""
    values, vectors = values.copy(), vectors.copy()
    z = np.matmul(update[:, None, :], vectors)[:, 0, :]
    length = np.sqrt((z * z).sum(1))
    safe = np.where(length > 0, length, 1.0)
    z, rho = z / safe[:, None], rho * length * length
    scale = (np.abs(values).max(1) + rho)[:, None]
    z[(rho[:, None] * np.abs(z) <= _TINY * scale) | (scale <= 0)] = 0.0
    _rotate_equal(values, vectors, z, scale)
    weights = z * z
    on = weights > 0
    delta, roots = secular_roots(values, weights, rho)
    # The update that has exactly these roots (Gu and Eisenstat) gives orthogonal vectors.
    d = values.shape[1]
    place = np.arange(d)
    with np.errstate(all="ignore"):
        later = np.minimum.accumulate(np.where(on, values, np.inf)[:, ::-1], axis=1)[:, ::-1]
        after = np.concatenate([later[:, 1:], np.full((len(values), 1), np.inf)], axis=1)
        final = on & ~np.isfinite(after)
        poles = np.where(place[None, :, None] > place[None, None, :], values[:, None, :], after[:, None, :])
        gaps = poles - values[:, :, None]  # (lane, i, j): pole that pairs with root j, seen from i
        ratio = np.where(final[:, None, :] | ~on[:, None, :], 1.0, -delta / gaps)
        end = np.where(final[:, None, :], -delta, 1.0).prod(2)
        size = np.sqrt(np.maximum(ratio.prod(2) * end / np.where(rho > 0, rho, 1.0)[:, None], 0.0))
        zhat = np.where(on, np.copysign(size, z), 0.0)
        q = zhat[:, :, None] / delta
        q = np.where(on[:, :, None] & on[:, None, :], q, 0.0)
        norm = np.sqrt((q * q).sum(1))
        q = q / np.where(norm > 0, norm, 1.0)[:, None, :]
    q += np.where(on, 0.0, 1.0)[:, None, :] * np.eye(d)
    order = np.argsort(roots, axis=1)
    vectors = np.matmul(vectors, np.take_along_axis(q, order[:, None, :], axis=2))
    return np.take_along_axis(roots, order, axis=1), vectors


class Spectrum:
    """Count, mean and scatter spectrum of some vectors, for a number of lanes at once."""

    def __init__(self, lanes: int, d: int):
        self.n, self.mean = np.zeros(lanes), np.zeros((lanes, d))
        self.values, self.vectors = np.zeros((lanes, d)), np.tile(np.eye(d), (lanes, 1, 1))

    def add(self, rows: np.ndarray) -> None:
        """One vector for each of the first lanes."""
        k = len(rows)
        step = rows - self.mean[:k]
        rho = self.n[:k] / (self.n[:k] + 1)
        if rho.any():
            self.values[:k], self.vectors[:k] = rank_one(self.values[:k], self.vectors[:k], step, rho)
        self.n[:k] += 1
        self.mean[:k] += step / self.n[:k, None]

    def merge(self, n: float, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        """Take another spectrum into the first lane by successive rank-one updates."""
        if n == 0:
            return
        v, u = self.values[:1], self.vectors[:1]
        for value, vector in zip(values, vectors.T, strict=True):
            if value > _TINY * values[-1]:
                v, u = rank_one(v, u, vector[None, :], np.array([value]))
        both = self.n[0] + n
        step = mean - self.mean[0]
        v, u = rank_one(v, u, step[None, :], np.array([self.n[0] * n / both]))
        self.values[:1], self.vectors[:1] = v, u
        self.mean[0] += step * (n / both)
        self.n[0] = both

    def one(self) -> Spectrum:
        """All lanes combined."""
        for lane in range(1, len(self.n)):
            self.merge(self.n[lane], self.mean[lane], self.values[lane], self.vectors[lane])
        return self


# -- Spark ------------------------------------------------------------------------------------------------------------

_ROW = "part long, n long, sums array<long>, mean array<double>, vals array<double>, vectors array<double>"


def usable(vector: str | Column) -> Column:
    """Whether a vector takes part."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def scaled(vector: str | Column) -> Column:
    """The integers that stand for the entries: ``floor(1024 * entry) + 100000``."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(v, lambda c: (F.floor(F.lit(1024.0) * c.cast("double")) + 100000).cast("long"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _levels(rows: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame], fan: int, folder: str, name: str):
    """Combine rows with an increasing ``part`` in groups of ``fan`` until one is left; returned as a Row or None."""
    level = 0
    now = stored(rows, folder, f"{name}_{level}")
    while (count := now.count()) > 1:
        level += 1
        groups = -(-count // fan)
        merged = now.groupBy(F.pmod(F.xxhash64("part"), F.lit(groups)).alias("_g")).applyInPandas(
            lambda _, part: combine(part), now.schema)
        now = stored(merged, folder, f"{name}_{level}")
    return now.first()


def _merge_spectra(d: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def combine(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        whole, sums = Spectrum(1, d), np.zeros(d, np.int64)
        for row in part.itertuples():
            whole.merge(float(row.n), np.asarray(row.mean), np.asarray(row.vals), np.asarray(row.vectors).reshape(d, d))
            sums += np.asarray(row.sums, np.int64)
        return pd.DataFrame({"part": [part["part"].iloc[0]], "n": [int(part["n"].sum())], "sums": [sums],
                             "mean": [whole.mean[0]], "vals": [whole.values[0]], "vectors": [whole.vectors[0].ravel()]})
    return combine


def _spectra(rows: DataFrame, d: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        state, sums, n, left = None, np.zeros(d, np.int64), 0, np.zeros((0, d), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            sums, n = sums + x.sum(0), n + len(x)
            state = state or Spectrum(max(1, min(_LANES, len(x) // _LANE_ROWS)), d)
            lanes = len(state.n)
            x = np.concatenate([left, x])
            whole = len(x) // lanes * lanes
            for at in range(0, whole, lanes):
                state.add(x[at:at + lanes].astype(float))
            left = x[whole:]
        if n:
            if len(left):
                state.add(left.astype(float))
            one = state.one()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()), "n": pa.array([n], pa.int64()),
                "sums": pa.array([sums], pa.list_(pa.int64())), "mean": pa.array([one.mean[0]], pa.list_(pa.float64())),
                "vals": pa.array([one.values[0]], pa.list_(pa.float64())),
                "vectors": pa.array([one.vectors[0].ravel()], pa.list_(pa.float64()))})

    return rows.select("_x").mapInArrow(run, _ROW)


def _gram(rows: DataFrame, d: int, n: int, sums: np.ndarray, basis: np.ndarray, fan: int, folder: str, name: str) -> np.ndarray:
    """Covariance, divisor n, of the centred vectors projected on ``basis``, with their mean taken off again."""
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        total, first, seen = np.zeros((k, k)), np.zeros(k), 0
        for batch in batches:
            y = ((_matrix(batch.column(0), d) * n - sums) / n) @ basis
            total, first, seen = total + y.T @ y, first + y.sum(0), seen + len(y)
        if seen:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "total": pa.array([total.ravel()], pa.list_(pa.float64())), "first": pa.array([first], pa.list_(pa.float64()))})

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        return pd.DataFrame({"part": [part["part"].iloc[0]], "total": [np.sum(part["total"].tolist(), axis=0)],
                             "first": [np.sum(part["first"].tolist(), axis=0)]})

    partial = rows.select("_x").mapInArrow(run, "part long, total array<double>, first array<double>")
    row = _levels(partial, combine, fan, folder, name)
    mean = np.array(row["first"]) / n
    return np.array(row["total"]).reshape(k, k) / n - np.outer(mean, mean)


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 8, fan: int = 16) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for each usable row and component."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    schema = f"key {rows.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, " \
             "explained double, identity_error double"
    empty = spark.createDataFrame([], schema).withColumnRenamed("key", key)
    rows = rows.where(usable(vector)).select(F.col(key).alias("_key"), scaled(vector).alias("_x"))
    common = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return empty
    d = common["d"]
    rows = rows.where(F.size("_x") == d)
    whole = _levels(_spectra(rows, d), _merge_spectra(d), fan, folder, "spectra")
    n, sums = whole["n"], np.array(whole["sums"], np.int64)
    basis, _ = np.linalg.qr(np.array(whole["vectors"]).reshape(d, d))
    projected = _gram(rows, d, n, sums, basis, fan, folder, "projected")
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    order = np.argsort(values)[::-1][:components]
    trace, k = float(np.trace(projected)), len(order)
    values, axes = values[order], (basis @ turn[:, order])
    axes = axes / np.sqrt((axes * axes).sum(0))
    fixed = [int(c) for c in range(k) if trace > 0 and values[c] > 1e-12 * values[0]]
    weights = axes[:, fixed] / np.sqrt(values[fixed])
    error = None
    if fixed:
        error = float(np.abs(_gram(rows, d, n, sums, weights, fan, folder, "whitened") - np.eye(len(fixed))).max())
    explained = [float(v / trace) if trace > 0 else None for v in values]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            m = batch.num_rows
            centred = _matrix(batch.column(1), d) * n - sums
            white = np.full((m, k), np.nan)
            white[:, fixed] = (centred / n) @ weights
            # Integer arithmetic wraps beyond a long; the estimate tells which sums do.
            fits = (centred.astype(float) ** 2).sum(1) < 9.2e18
            exact = pa.array((centred * centred).sum(1), mask=~fits)
            again = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()), exact.take(pa.array(again)),
                pa.array(white.ravel(), mask=np.isnan(white.ravel())), pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * k), pa.float64())],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
