"""One-class SVM with an RBF kernel (Schoelkopf et al. 2001), fitted in the primal.

The kernel space is spanned by landmark users (Nystroem; Williams & Seeger
2001), which is exact while the landmarks cover all users. In that space

    1/2 |w|^2 - rho + 1/(nu n) sum max(0, rho - w phi)

is minimised by Newton steps on a hinge smoothed over a shrinking width. Each
step is one pass over all users that adds up a loss, a gradient and a Hessian of
fixed size; the users stay in their partitions.

The support vectors are users in sparse regions, so landmarks are drawn with a
probability that rises steeply as the kernel density at a user falls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.models.arrays import sum_over_shards, vectors_of
from riskloom.params import RiskParams, SvmParams

_DAMPING = 0.1  # curvature in rho that stays when no user is near the border
_TOLERANCE = 1e-8  # last Newton gain, relative to the squared norm of w
_NARROWEST = 0.01  # last smoothing width, relative to the spread of projections
_PREFERENCE = 12  # power of 1 / density that weighs the draw of landmarks


@dataclass(frozen=True)
class SvmModel:
    landmarks: np.ndarray  # landmarks x features
    weights: np.ndarray  # one per landmark
    rho: float
    gamma: float
    scale: float  # nu * n, or 1

    def decision(self, data: np.ndarray) -> np.ndarray:
        return self.scale * (rbf(data, self.landmarks, self.gamma) @ self.weights - self.rho)


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(square, 0.0))


class _Passes:
    """Passes over all users that return one summed vector."""

    def __init__(self, data: DataFrame, shards: int):
        self.data, self.shards = data, shards
        self.context = data.sparkSession.sparkContext

    def total(self, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def per_shard(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
            sums = None
            for block in blocks:
                part = of_block(block)
                sums = part if sums is None else sums + part
            return sums

        return sum_over_shards(self.data, self.shards, per_shard)


def gamma_of(passes: _Passes, gamma: float | str) -> float:
    """A number as given, or "scale": 1 / (features x variance of all entries)."""
    if gamma != "scale":
        return float(gamma)
    rows, features, first, second = passes.total(
        lambda x: np.array([len(x), x.size, x.sum(), (x * x).sum()])
    )
    variance = second / features - (first / features) ** 2
    return float(rows / (features * variance)) if variance > 1e-12 else 1.0


def _vectors(users: DataFrame, order: str, count: int) -> np.ndarray:
    chosen = users.select(order, "user_id", "x").orderBy(order, "user_id").limit(count)
    return np.array([r["x"] for r in chosen.collect()], dtype=float)


def choose_landmarks(passes: _Passes, gamma: float, params: RiskParams) -> np.ndarray:
    """``svm.landmarks`` users drawn without replacement, all users if there are no more.

    The draw is the same at every size: a user's hash u gives the key -log(u) x
    density ** _PREFERENCE, and the smallest keys win (weighted sampling; Efraimidis
    and Spirakis 2006). The density is the mean kernel to as many users with the
    smallest hashes. One user more or less thus changes one landmark or two.
    """
    count = params.svm.landmarks
    hashed = F.xxhash64(F.lit(params.seed), F.lit("landmark"), F.col("user_id"))
    unit = (F.shiftrightunsigned(hashed, 11) + 0.5) * F.lit(2.0**-53)
    drawn = passes.data.select("user_id", "x", unit.alias("u"))

    shared = passes.context.broadcast(_vectors(drawn, "u", count))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            density = rbf(vectors_of(batch, 1), shared.value, gamma).mean(axis=1)
            u = batch.column(2).to_numpy(zero_copy_only=False)
            key = np.log(-np.log(u)) + _PREFERENCE * np.log(np.maximum(density, 1e-300))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(key)], names=["user_id", "x", "key"]
            )

    keyed = drawn.mapInArrow(keys, "user_id long, x array<double>, key double")
    return _vectors(keyed, "key", count)


def _smooth_hinge(gap: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(0, gap) rounded off inside +-width: value, slope, curvature."""
    inside = np.abs(gap) < width
    lift = np.where(inside, gap + width, 0.0)
    value = np.where(inside, lift * lift / (4 * width), np.maximum(gap, 0.0))
    slope = np.where(inside, lift / (2 * width), (gap > 0).astype(float))
    return value, slope, inside / (2 * width)


def fit(data: DataFrame, users: int, shards: int, params: RiskParams) -> SvmModel:
    """Fit on all users; ``data`` comes from :func:`riskloom.models.arrays.sharded`.

    ``rho`` is the one of the smoothed problem; the caller replaces it with the
    exact nu-quantile of the users' projections.
    """
    svm = params.svm
    if svm.kernel != "rbf":
        raise ValueError(f"unsupported kernel: {svm.kernel}")
    passes = _Passes(data, shards)
    gamma = gamma_of(passes, svm.gamma)
    landmarks = choose_landmarks(passes, gamma, params)
    values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
    keep = values > 1e-10 * values.max()
    basis = vectors[:, keep] / np.sqrt(values[keep])
    solution = _minimise(passes, users, landmarks, basis, gamma, svm)
    scale = svm.nu * users if svm.scale == "count" else 1.0
    return SvmModel(landmarks, basis @ solution[:-1], float(solution[-1]), gamma, scale)


def _minimise(
    passes: _Passes,
    users: int,
    landmarks: np.ndarray,
    basis: np.ndarray,
    gamma: float,
    svm: SvmParams,
) -> np.ndarray:
    """Damped Newton over (w, rho); the smoothing narrows while steps get small.

    While the same users stay near the border the error is linear in the width, so
    the solutions at the last width and at twice that are extrapolated to width 0.
    """
    space = passes.context.broadcast((landmarks, basis))
    size = basis.shape[1] + 1
    upper = np.triu_indices(size)
    per_user = 1.0 / (svm.nu * users)

    def features(block: np.ndarray) -> np.ndarray:
        points, to_basis = space.value
        return rbf(block, points, gamma) @ to_basis

    mean = passes.total(lambda x: features(x).sum(axis=0)) / users

    def projection_moments(block: np.ndarray) -> np.ndarray:
        s = features(block) @ mean
        return np.array([s.sum(), (s * s).sum()])

    first, second = passes.total(projection_moments) / users
    spread = max(float(np.sqrt(max(second - first * first, 0.0))), 1e-6)

    def evaluate(at: np.ndarray, width: float) -> tuple[float, np.ndarray, np.ndarray]:
        def parts(block: np.ndarray) -> np.ndarray:
            phi = np.column_stack([-features(block), np.ones(len(block))])
            value, slope, curve = _smooth_hinge(phi @ at, width)
            bent = phi[curve > 0]
            hessian = (bent.T @ bent) * (0.5 / width)
            return np.concatenate([[value.sum()], slope @ phi, hessian[upper]])

        sums = passes.total(parts) * per_user
        hessian = np.zeros((size, size))
        hessian[upper] = sums[1 + size :]
        hessian += np.triu(hessian, 1).T
        hessian[np.diag_indices(size)] += np.append(np.ones(size - 1), _DAMPING * per_user / width)
        w = at[:-1]
        loss = 0.5 * float(w @ w) - at[-1] + sums[0]
        return loss, sums[1 : 1 + size] + np.append(w, -1.0), hessian

    point, width = np.append(mean, first - 1.645 * spread), spread
    narrowest, wider = 2 * spread * _NARROWEST, None
    loss, gradient, hessian = evaluate(point, width)
    done = 1
    while done < svm.max_passes:
        step = -np.linalg.solve(hessian, gradient)
        gain = float(-gradient @ step)
        size_of_w = float(point[:-1] @ point[:-1])
        if width <= narrowest and gain < _TOLERANCE * size_of_w:
            if wider is not None:
                break
            wider, narrowest = point, narrowest / 2
        # A narrower hinge is never above a wider one, so losses stay comparable.
        narrower = gain < 0.3 * size_of_w and width > narrowest
        next_width = max(width / 2, narrowest) if narrower else width
        length = 1.0
        while True:
            trial = evaluate(point + length * step, next_width)
            done += 1
            enough = 0.0 if narrower else 1e-4 * length * gain
            if trial[0] <= loss - enough or length < 1e-3 or done >= svm.max_passes:
                break
            excess = trial[0] - loss + gain * length
            length *= min(max(gain * length / (2 * excess), 0.1), 0.6)
        point, width = point + length * step, next_width
        loss, gradient, hessian = trial
    return point if wider is None else 2 * point - wider
