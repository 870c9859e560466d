"""Euclidean silhouettes and their bounds against brute force over all pairs."""

import numpy as np
import pytest

from staylytics.operators import cluster as CL
from staylytics.operators import kmeans as KM
from staylytics.operators import silhouette as SL

COLS = ["a", "b", "c"]


def brute(x, label):
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(axis=2))
    known, own = np.unique(label, return_inverse=True)
    total = np.array([d[:, own == j].sum(axis=1) for j in range(len(known))]).T
    n, at = np.bincount(own), np.arange(len(x))
    a = total[at, own] / np.maximum(n[own] - 1, 1)
    mean = total / n
    mean[at, own] = np.inf
    b = mean.min(axis=1)
    with np.errstate(invalid="ignore"):
        s = (b - a) / np.maximum(a, b)
    return np.where((n[own] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0), s, 0)


def frame(spark, x, label):
    rows = [(i, *map(float, p), None if c is None else int(c)) for i, (p, c) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "listing_id long, a double, b double, c double, cluster int").repartition(5)


@pytest.fixture(scope="module")
def blobs():
    r = np.random.default_rng(8)
    x = np.concatenate([r.normal(m, 0.7, (n, 3)) for m, n in (((0, 0, 0), 700), ((3, 0, 1), 300), ((0, 4, 2), 400))]
                       + [np.repeat([[1.0, 1.0, 1.0]], 600, axis=0)])  # a hot point
    return x, np.repeat([0, 1, 2, 5], [700, 300, 400, 600])


def test_rows_are_exact_with_a_leaf_for_each_point(spark, blobs):
    x, label = blobs
    got = SL.rows(frame(spark, x, label), COLS, cells=2000).orderBy("listing_id").collect()
    want = brute(x, label)
    for c in SL.COLUMNS:
        assert np.allclose([r[c] for r in got], want, atol=1e-6)


def test_bounds_hold_and_narrow(spark, blobs):
    x, label = blobs
    want, gaps = brute(x, label), []
    df = frame(spark, x, label)
    for cells in (1, 20, 300):
        got = np.array([r[1:] for r in SL.rows(df, COLS, cells=cells).orderBy("listing_id").select("listing_id", *SL.COLUMNS).collect()])
        est, low, high = got.T
        assert (low <= want + 1e-6).all() and (want <= high + 1e-6).all() and (low <= est).all() and (est <= high).all()
        gaps.append((high - low).mean())
    assert gaps[0] > gaps[1] > gaps[2] and abs(est.mean() - want.mean()) < 0.01


def test_models_open_cells_are_added(spark, blobs):
    x, _ = blobs
    pts = KM.points(frame(spark, x, np.zeros(len(x))), COLS).persist()
    r = np.random.default_rng(1)
    models = [KM.Model(k, 0, x[r.choice(1400, k, replace=False)]) for k in (2, 3, 4, 6)]
    want = [brute(x, ((x[:, None] - m.centers[None]) ** 2).sum(axis=2).argmin(axis=1)).mean() for m in models]
    for got in (SL.of_models(pts, models, 16, 2000), SL.of_models(pts, models, 2000)):
        assert all(low - 1e-6 <= w <= high + 1e-6 for (_, low, high, _), w in zip(got, want))
        assert int(np.argmax([g[0] for g in got])) == int(np.argmax(want))
    assert np.allclose([g[0] for g in got], want, atol=1e-6)


def test_defined_cases(spark):
    one = frame(spark, np.eye(3), [0, 0, 0])
    assert [r[SL.COLUMNS[0]] for r in SL.rows(one, COLS).collect()] == [0, 0, 0]  # no second cluster
    lone = SL.rows(frame(spark, np.array([[0.0, 0, 0], [1, 0, 0], [9, 0, 0], [5, 5, 5]]), [0, 0, 3, None]), COLS).orderBy("listing_id").collect()
    assert [r["listing_id"] for r in lone] == [0, 1, 2] and lone[2][SL.COLUMNS[0]] == 0  # a cluster of one; no cluster
    assert lone[0][SL.COLUMNS[0]] == pytest.approx(8 / 9)
    same = SL.rows(frame(spark, np.ones((4, 3)), [0, 0, 1, 1]), COLS).collect()
    assert all(r[c] == 0 for r in same for c in SL.COLUMNS)
    none = SL.rows(one.where("false"), COLS)
    assert none.count() == 0 and none.columns[-3:] == list(SL.COLUMNS)
    assert np.isnan(SL.of_models(KM.points(one.where("false"), COLS), [KM.Model(2, 0, np.zeros((2, 3)))])[0][0])


def test_both_silhouettes_of_a_sweep(spark, blobs):
    x, _ = blobs
    sweep = CL.kmeans_sweep(frame(spark, x[:1400], np.zeros(1400)), COLS, ks=(2, 3, 4), seeds=(42, 43))
    for m in sweep:
        label = ((x[:1400, None] - m.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert m.low - 1e-6 <= brute(x[:1400], label).mean() <= m.high + 1e-6 and m.silhouette_sq > m.silhouette
    assert CL.best_k(sweep) == 3
    df = frame(spark, x[:1400], label)  # its rows by the tree of the sweep
    assert np.isclose(SL.rows(df, COLS, tree=sweep[-1].tree).agg({SL.COLUMNS[0]: "avg"}).first()[0], sweep[-1].silhouette)
    assert SL.rows(df.where("false"), COLS, tree=sweep[-1].tree).count() == 0
