"""K-Means for many numbers of clusters and restarts at once.

All models take their Lloyd steps together. One pass over the points
compares each with the centres of every model that still moves, a task
sums its points by centre, and the tasks' sums are added in a tree; so a sweep over
K with restarts needs as many jobs as its slowest model, not one set for
each model. The driver holds the centres only.

Restarts start by k-means++: the next centre is a point drawn with
probability weight * squared distance to the nearest centre so far. Each
point draws an exponential time at that rate from a hash of its key, and the
least time wins, so a draw is one pass with a minimum for each task. Of a
few points drawn, a second pass finds the one that leaves the least distances. The
centres of a restart do not depend on K: its first k points start the
model of k clusters.

A model rests when its centres move by no more than ``tol`` times the mean
variance in squared distance together; the best restart of each K
then goes on until none of its centres moves by more than ``tol``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

#: Restarts of every fit; the one of lowest cost counts, the first one on ties.
SEEDS = tuple(range(42, 52))
MAX_ITER, TOL = 300, 1e-4
#: Points that are compared with all centres at a time.
ROWS = 2048


@dataclass
class Model:
    """One fit: its centres (k x columns), the sum of squared distances and the number of Lloyd steps."""

    k: int
    seed: int
    centers: np.ndarray
    cost: float = float("inf")
    steps: int = 0
    moves: bool = True


def points(df: DataFrame, cols: list[str], weight: str | None = None) -> RDD:
    """Blocks (key, weight, matrix of the columns) of at most ROWS rows; the key is a hash of the row.

    The passes run over arrays and need no plan of their own, so this is one
    of the few places where an RDD is the right form. Keep it with persist().
    """
    ship_package(df.sparkSession)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    frame = df.select(F.xxhash64(*df.columns).alias("key"), w.alias("w"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

    def pack(batches):
        for batch in batches:
            key, w, *x = (c.to_numpy() for c in batch.columns)
            x = np.column_stack(x)
            for i in range(0, batch.num_rows, ROWS):
                part = [a[i:i + ROWS].tobytes() for a in (key, w, x)]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in part], names=["key", "w", "x"])

    d = len(cols)
    return frame.mapInArrow(pack, "key binary, w binary, x binary").rdd.map(
        lambda r: (np.frombuffer(r[0], np.int64), np.frombuffer(r[1]), np.frombuffer(r[2]).reshape(-1, d)))


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from keys."""
    h = key.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0 ** -54


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centre."""
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1)[None, :]
    return np.maximum(d, 0, out=d)


def sums(x: np.ndarray, w: np.ndarray, centers: np.ndarray, sizes: list[int]) -> np.ndarray:
    """For every centre of every model (they stand one after another, ``sizes`` centres each): weight and weighted
    sum of its points, their weighted squared norms and squared distances.
    """
    edge = np.concatenate([[0], np.cumsum(sizes)])
    d = distances(x, centers)
    best = np.column_stack([a + d[:, a:b].argmin(axis=1) for a, b in zip(edge[:-1], edge[1:])])
    rows = np.arange(len(x))[:, None]
    mine, near = np.zeros_like(d), np.zeros_like(d)
    mine[rows, best] = w[:, None]
    near[rows, best] = w[:, None] * d[rows, best]
    return np.column_stack([mine.sum(axis=0), mine.T @ x, mine.T @ (x * x).sum(axis=1), near.sum(axis=0)])


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + b


def _least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rows with the lesser first value."""
    return np.where(a[:, :1] <= b[:, :1], a, b)


def _passed(pts: RDD, task, join) -> np.ndarray | None:
    """``task`` on each block, joined within tasks, then among them in a tree; None if there are no points."""
    both = lambda a, b: b if a is None else a if b is None else join(a, b)
    return pts.treeAggregate(None, lambda total, block: both(total, task(*block)), both)


def starts(pts: RDD, k: int, seeds) -> list[np.ndarray]:
    """k-means++ points of each seed, k of each (fewer rows than k: some are repeated); none if there are no points."""
    chosen: list[np.ndarray] = []
    trials = 2 + int(np.log(k))
    for r in range(k):
        tried = trials if r else 1

        def draw(key, w, x):
            out = np.empty((len(seeds) * tried, 1 + x.shape[1]))  # noqa: B023
            for j, seed in enumerate(seeds):
                rate = w * distances(x, chosen[j]).min(axis=1) if chosen else w  # noqa: B023
                for t in range(tried):  # noqa: B023
                    with np.errstate(divide="ignore"):
                        at = -np.log(_mixed(key, (seed * 1009 + r) * 64 + t)) / rate  # noqa: B023
                    i = int(at.argmin())
                    out[j * tried + t] = at[i], *x[i]  # noqa: B023
            return out

        got = _passed(pts, draw, _least)
        if got is None:
            return []
        drawn = got[:, 1:].reshape(len(seeds), tried, -1)
        if not r:
            chosen = [c for c in drawn]
            continue

        def left(key, w, x):
            out = np.empty((len(seeds), tried))  # noqa: B023
            for j in range(len(seeds)):
                near = distances(x, chosen[j]).min(axis=1)  # noqa: B023
                out[j] = w @ np.minimum(near[:, None], distances(x, drawn[j]))  # noqa: B023
            return out

        best = _passed(pts, left, _sum).argmin(axis=1)
        chosen = [np.concatenate([c, d[i:i + 1]]) for c, d, i in zip(chosen, drawn, best)]
    return chosen


def step(pts: RDD, models: list[Model]) -> np.ndarray:
    """sums() of all models over all points, by one job."""
    centers, sizes = np.concatenate([m.centers for m in models]), [m.k for m in models]
    return _passed(pts, lambda key, w, x: sums(x, w, centers, sizes), _sum)


def _moved(models: list[Model], got: np.ndarray) -> list[np.ndarray]:
    """Moves each model's centres to the means of their points (one without points stays); the squared moves."""
    moves, at = [], 0
    for m in models:
        own = got[at:at + m.k]
        at += m.k
        new = np.where(own[:, :1] > 0, own[:, 1:-2] / np.where(own[:, :1] > 0, own[:, :1], 1), m.centers)
        moves.append(((new - m.centers) ** 2).sum(axis=1))
        m.centers, m.cost, m.steps = new, float(own[:, -1].sum()), m.steps + 1
    return moves


def fit(pts: RDD, ks, seeds=SEEDS, max_iter: int = MAX_ITER, tol: float = TOL) -> list[Model]:
    """The best restart for each k; no models if there are no points.

    ``pts`` is read once for each step of the slowest model: keep it with persist().
    """
    ks = list(ks)
    first = starts(pts, max(ks), seeds)
    if not first:
        return []
    models = [Model(k, s, c[:k].copy()) for k in ks for s, c in zip(seeds, first)]
    spread = None
    for _ in range(max_iter):
        live = [m for m in models if m.moves]
        if not live:
            break
        got = step(pts, live)
        if spread is None:  # the mean variance of the columns, from the sums of the first model
            own = got[:live[0].k]
            n = own[:, 0].sum()
            spread = (own[:, -2].sum() / n - ((own[:, 1:-2].sum(axis=0) / n) ** 2).sum()) / (own.shape[1] - 3)
        for m, moved in zip(live, _moved(live, got)):
            m.moves = moved.sum() > tol * max(spread, 0)
    # costs are those before the last move: equal enough to choose by; the chosen ones go on
    best = [min((m for m in models if m.k == k), key=lambda m: m.cost) for k in ks]
    for m in best:
        m.moves = True
    for _ in range(max_iter):
        live = [m for m in best if m.moves and m.steps < max_iter]
        if not live:
            break
        for m, moved in zip(live, _moved(live, step(pts, live))):
            m.moves = moved.max() > tol * tol
    return best


def silhouettes(pts: RDD, models: list[Model]) -> list[float]:
    """Sets the models' cost and gives the mean squared-Euclidean silhouette of each, over all points, in two jobs."""
    got, at, known = step(pts, models), 0, []
    for m in models:
        own = got[at:at + m.k]
        at += m.k
        m.cost = float(own[:, -1].sum())
        known.append(own)
    centers = [m.centers for m in models]

    def one(key, w, x):
        return np.array([[(w * silhouette_of(x, c, own)).sum(), w.sum()] for c, own in zip(centers, known)])

    return [float(s / n) if n else float("nan") for s, n in _passed(pts, one, _sum)]


def silhouette_of(x: np.ndarray, centers: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Squared-Euclidean silhouette of points in the cluster of their nearest centre; ``own`` has the clusters' sums().

    The mean squared distance to a cluster is |x|^2 - 2 x.mean + mean of its squared norms.
    """
    label, n = distances(x, centers).argmin(axis=1), own[:, 0]
    full = n > 0
    size = np.where(full, n, 1)
    mean = own[:, 1:-2] / size[:, None]
    d = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ mean.T + (own[:, -2] / size)[None, :], 0)
    rows = np.arange(len(x))
    a = d[rows, label] * n[label] / np.maximum(n[label] - 1, 1)
    d[:, ~full] = np.inf
    d[rows, label] = np.inf
    b = d.min(axis=1)
    top = np.maximum(a, b)
    with np.errstate(invalid="ignore"):
        s = np.where(np.isinf(b) | (top == 0) | (n[label] <= 1), 0, (b - a) / np.where(top == 0, 1, top))
    return s


def assign(df: DataFrame, cols: list[str], centers: np.ndarray, name: str = "cluster") -> DataFrame:
    """``df`` with the number of the nearest centre of each row, the least one on ties; built-in expressions only."""
    def d2(c):
        return sum((F.col(f"`{x}`") - F.lit(float(v))) * (F.col(f"`{x}`") - F.lit(float(v))) for x, v in zip(cols, c))

    each = [F.struct(d2(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]
    return df.withColumn(name, (F.least(*each) if len(each) > 1 else each[0])["i"])
