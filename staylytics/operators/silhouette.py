"""Euclidean silhouette over all rows, between bounds.

The mean Euclidean distance of a point to a cluster has no closed form in
a few sums, unlike that of squared distances, and all pairs are not an
option. The points are therefore cut into the leaves of a tree of cells,
and each point meets the summary of every leaf: number, mean c and mean
squared distance v from c of a cluster's points in it. For n such points at mean
distance m of a point x, with d = |x - c|,

    d <= m <= sqrt(d^2 + v)

(the norm is convex, the root concave), so every point has bounds of its
distance to its own and to the nearest other cluster, hence of its
silhouette: it grows with the latter and falls with the former. The
estimate lies half way between the distances' bounds. A leaf with one
distinct point has v = 0: with no fewer leaves than distinct points the result
is exact up to rounding.

The tree grows from one leaf: a pass over the points measures each leaf, and
those with the greatest sum of squared distances from their mean are cut at the
mean of their widest column, until there are ``cells`` leaves or none can
be cut. Passes follow the depth of the tree. The driver and every task
hold the tree and at most ``cells`` summaries for each cluster; work is
rows x leaves, in numpy within tasks.

Defined cases: a cluster of one row has silhouette 0; without a second
cluster it is 0; columns must not be null (features are filled before).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kmeans as KM

#: Leaves of the tree at first and at most; while the best of some labellings is open, there are four times as many.
CELLS, MOST_CELLS = 1024, 4096
#: Points that meet all summaries at a time.
ROWS = 256


def _grouped(codes: np.ndarray, parts: list[tuple]) -> tuple:
    """Rows with the same code joined: each part is (ufunc, array)."""
    order = np.argsort(codes, kind="stable")
    found, start = np.unique(codes[order], return_index=True)
    return found, [(f, f.reduceat(a[order], start, axis=0)) for f, a in parts]


def _joined(a: tuple, b: tuple) -> tuple:
    return _grouped(np.concatenate([a[0], b[0]]), [(f, np.concatenate([x, y])) for (f, x), (_, y) in zip(a[1], b[1])])


@dataclass
class Tree:
    """Nodes as arrays: a leaf has axis -1, the children of an inner node are ``child`` (up to ``cut``) and the next one."""

    axis: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    middle: np.ndarray
    whole: bool = False  # no leaf can be cut: each is one distinct point

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            rows = rows[self.axis[at[rows]] >= 0]
            if not len(rows):
                return at
            node = at[rows]
            at[rows] = self.child[node] + (x[rows, self.axis[node]] > self.cut[node])


def grow(pts: RDD, columns: int, cells: int, tree: Tree | None = None) -> Tree | None:
    """The tree with ``cells`` leaves, grown on from ``tree``; None if there are no points. ``pts`` has blocks (weight, matrix)."""
    if tree is None:
        tree = Tree(np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.zeros((1, columns)))
    while True:
        def measure(w, x):
            v = w[:, None]
            return _grouped(tree.leaf(x), [(np.add, np.column_stack([w, v * x, v * x * x])), (np.minimum, x), (np.maximum, x)])  # noqa: B023

        got = KM._passed(pts, measure, _joined)
        if got is None:
            return None
        leaf, ((_, total), (_, low), (_, high)) = got
        n = total[:, :1]
        mean = total[:, 1:columns + 1] / n
        spread = np.where(high > low, np.maximum(total[:, columns + 1:] / n - mean * mean, 1e-300), 0)
        tree.middle[leaf] = (low + high) / 2
        error = n[:, 0] * spread.sum(axis=1)
        tree.whole = not (error > 0).any()
        pick = np.argsort(-error, kind="stable")[:max(cells - len(leaf), 0)]
        pick = pick[error[pick] > 0]
        if not len(pick):
            return tree
        axis = spread[pick].argmax(axis=1)
        at = np.arange(len(pick))
        least, most = low[pick][at, axis], high[pick][at, axis]
        cut = mean[pick][at, axis]
        size = len(tree.axis)
        tree.axis[leaf[pick]], tree.cut[leaf[pick]] = axis, np.where((cut >= least) & (cut < most), cut, least)
        tree.child[leaf[pick]] = size + 2 * at
        new = 2 * len(pick)
        tree = Tree(np.append(tree.axis, np.full(new, -1)), np.append(tree.cut, np.zeros(new)),
                    np.append(tree.child, np.zeros(new, np.int64)), np.concatenate([tree.middle, np.zeros((new, columns))]))


@dataclass
class Summary:
    """One labelling: mean, mean squared distance from it and number of each (leaf, cluster) with points; clusters' numbers."""

    mean: np.ndarray
    spread: np.ndarray
    count: np.ndarray  # summaries x clusters: the number in the column of its cluster
    label: np.ndarray  # sorted numbers of the clusters

    def bounds(self, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Columns: estimate, lower and upper bound of the silhouette of each point."""
        return np.concatenate([self._bounds(x[i:i + ROWS], label[i:i + ROWS]) for i in range(0, len(x), ROWS)] or [np.zeros((0, 3))])

    def _bounds(self, x, label):
        d2 = KM.distances(x, self.mean)
        n = self.count.sum(axis=0)
        low = np.sqrt(d2) @ self.count
        d2 += self.spread
        high = np.sqrt(d2, out=d2) @ self.count
        own, rows = np.searchsorted(self.label, label), np.arange(len(x))
        out, single = [], (n[own] <= 1) | (len(n) < 2)

        def near(s):
            b = s / n
            b[rows, own] = np.inf
            return b.min(axis=1)

        alow, ahigh = (s[rows, own] / np.maximum(n[own] - 1, 1) for s in (low, high))
        for a, b in (((alow + ahigh) / 2, (near(low) + near(high)) / 2), (ahigh, near(low)), (alow, near(high))):
            with np.errstate(invalid="ignore", divide="ignore"):
                top = np.maximum(a, b)
                out.append(np.where(single | (top == 0), 0, (b - a) / top))
        return np.column_stack(out)


def summaries(pts: RDD, tree: Tree, split) -> list[Summary]:
    """One pass: the summaries of every labelling; ``split`` gives the points of a block's matrix and a list of arrays of cluster numbers."""
    def task(w, block):
        x, per = split(block)
        leaf = tree.leaf(x)
        y = x - tree.middle[leaf]
        sums = np.column_stack([w, w[:, None] * y, w * (y * y).sum(axis=1)])
        codes = np.concatenate([(m << 48) + (leaf << 24) + own for m, own in enumerate(per)])
        return _grouped(codes, [(np.add, np.concatenate([sums] * len(per)))])

    got = KM._passed(pts, task, _joined)
    if got is None:
        return []
    codes, ((_, total),) = got
    out = []
    for m in range(int(codes[-1] >> 48) + 1):
        mine = codes >> 48 == m
        leaf, label = codes[mine] >> 24 & (1 << 24) - 1, codes[mine] & (1 << 24) - 1
        n, at = total[mine, 0], total[mine, 1:-1] / total[mine, :1]
        known, column = np.unique(label, return_inverse=True)
        count = np.zeros((len(n), len(known)))
        count[np.arange(len(n)), column] = n
        out.append(Summary(tree.middle[leaf] + at, np.maximum(total[mine, -1] / n - (at * at).sum(axis=1), 0), count, known))
    return out


def of_models(pts: RDD, models: list[KM.Model], cells: int = CELLS, most: int = MOST_CELLS) -> list[tuple]:
    """(estimate, lower, upper, tree) of the mean Euclidean silhouette of each K-Means model over all points.

    Models whose upper bound is under the best lower bound are decided;
    while others are open, the tree gets four times as many leaves for them, up to ``most``.
    ``pts`` is that of kmeans.points(): keep it with persist().
    """
    plain = pts.map(lambda b: (b[1], b[2]))
    out: list[tuple] = [(float("nan"),) * 3 + (None,)] * len(models)
    open_, tree = list(range(len(models))), None
    while True:
        tree = grow(plain, models[0].centers.shape[1], cells, tree) if models else None
        if tree is None:
            return out
        centers = [models[i].centers for i in open_]
        split = lambda x: (x, [KM.distances(x, c).argmin(axis=1) for c in centers])  # noqa: B023, E731
        known = summaries(plain, tree, split)

        def task(w, x):
            return np.array([[*(w @ s.bounds(x, own)), w.sum()] for s, own in zip(known, split(x)[1])])  # noqa: B023

        for i, (*s, n) in zip(open_, KM._passed(plain, task, KM._sum)):
            out[i] = (*(float(v / n) for v in s), tree)
        best = max(o[1] for o in out)
        open_ = [i for i in open_ if out[i][2] >= best]
        if len(open_) < 2 or tree.whole or cells >= most:
            return out
        cells = min(cells * 4, most)


COLUMNS = ("silhouette_euclidean", "silhouette_euclidean_low", "silhouette_euclidean_high")


def rows(df: DataFrame, cols: list[str], cluster: str = "cluster", cells: int = CELLS, tree: Tree | None = None) -> DataFrame:
    """``df`` with estimate, lower and upper bound of the Euclidean silhouette of each row (COLUMNS); rows without cluster go.

    Cluster numbers lie between 0 and 2^24 - 1. ``tree`` is one that has grown on these points (of_models gives it); without it
    one of ``cells`` leaves is grown. ``df`` is read twice: hand a written or persisted frame.
    """
    df = df.where(F.col(cluster).isNotNull())
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in COLUMNS]])
    pts = KM.points(df, [*cols, cluster]).map(lambda b: (b[1], b[2])).persist()
    try:
        # the cluster is the last column of the blocks; the tree grows on the others
        tree = tree or grow(pts.map(lambda b: (b[0], b[1][:, :-1])), len(cols), cells)
        if tree is None:
            return df.select("*", *[F.lit(None).cast("double").alias(c) for c in COLUMNS])
        known = (summaries(pts, tree, lambda m: (m[:, :-1], [m[:, -1].astype(np.int64)])) or [None])[0]
    finally:
        pts.unpersist()

    def task(batches):
        for batch in batches:
            x = np.column_stack([batch[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols])
            own = batch[cluster].to_numpy(zero_copy_only=False).astype(np.int64)
            got = known.bounds(x, own)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in got.T]], names=[*batch.schema.names, *COLUMNS])

    return df.mapInArrow(task, schema)
