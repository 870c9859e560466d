"""K-Means passes against plain numpy, model by model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylytics.operators import cluster as CL
from staylytics.operators import kmeans as KM


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(c, 0.4, (n, 3)) for c, n in (((0, 0, 0), 900), ((3, 0, 1), 300), ((0, 4, 2), 2500), ((5, 5, 5), 40))])
    rows = [(i, *map(float, p)) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "listing_id long, a double, b double, c double").repartition(5), x


def plain_step(x, centers):
    d = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    best = d.argmin(axis=1)
    return np.array([[(best == j).sum(), *x[best == j].sum(axis=0), (x[best == j] ** 2).sum(), d[best == j, j].sum()] for j in range(len(centers))])


def test_one_step_of_all_models(data):
    df, x = data
    r = np.random.default_rng(4)
    models = [KM.Model(k, s, r.normal(2, 2, (k, 3))) for k in range(2, 11) for s in range(10)]
    got = KM.step(KM.points(df, ["a", "b", "c"]), models)
    assert np.allclose(got, np.concatenate([plain_step(x, m.centers) for m in models]), rtol=1e-9, atol=1e-7)
    KM._moved(models, got)
    for m in models[::17]:
        want = plain_step(x, m.centers)  # the moved centres are means of their points
        assert m.steps == 1 and want[:, -1].sum() <= m.cost * (1 + 1e-9)


def test_fit_finds_the_clusters(data):
    df, x = data
    pts = KM.points(df, ["a", "b", "c"]).persist()
    models = KM.fit(pts, range(2, 6))
    four = models[2]
    assert sorted(plain_step(x, four.centers)[:, 0]) == [40, 300, 900, 2500]
    s = KM.silhouettes(pts, models)
    assert int(np.argmax(s)) == 2 and all(a.cost > b.cost for a, b in zip(models, models[1:]))
    for m, v in zip(models, s):  # brute silhouette with squared distances, on every tenth point
        d = ((x[::10, None, :] - x[None]) ** 2).sum(axis=2)
        label = ((x[:, None, :] - m.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        mean = np.array([d[:, label == j].sum(axis=1) for j in range(m.k)]).T
        n = np.bincount(label, minlength=m.k)
        own = label[::10]
        at = np.arange(len(own))
        a = mean[at, own] / np.maximum(n[own] - 1, 1)
        b = mean / n
        b[at, own] = np.inf
        b = b.min(axis=1)
        stats = np.concatenate([np.zeros((0, 6)), plain_step(x, m.centers)])
        assert np.allclose(KM.silhouette_of(x[::10], m.centers, stats), np.where(n[own] > 1, (b - a) / np.maximum(a, b), 0), atol=1e-9)
        assert -1 <= v <= 1
    again = KM.fit(KM.points(df.repartition(3), ["a", "b", "c"]), [4])[0]  # draws depend on the rows only
    assert np.allclose(again.centers, KM.fit(pts, [4])[0].centers)
    label = KM.assign(df, ["a", "b", "c"], four.centers).groupBy("cluster").agg(F.count("*").alias("n")).collect()
    assert sorted(r["n"] for r in label) == [40, 300, 900, 2500]


def test_draws_follow_the_distances(spark):
    """Shares of the second point of k-means++ over many seeds: in proportion to weight * squared distance."""
    df = spark.createDataFrame([(0, 0.0, 1000.0), (1, 1.0, 4.0), (2, 2.0, 3.0), (3, 4.0, 0.5)], "listing_id int, x double, w double")
    pts = KM.points(df, ["x"], "w").persist()
    x, w = np.array([0.0, 1, 2, 4]), np.array([1000, 4, 3, 0.5])
    key = np.arange(40_000, dtype=np.int64)
    u = KM._mixed(key, 7)
    assert abs(u.mean() - 0.5) < 0.01 and abs((u < 0.1).mean() - 0.1) < 0.01 and abs(np.corrcoef(u, KM._mixed(key, 8))[0, 1]) < 0.02
    first = [KM.starts(pts, 1, [s])[0][0, 0] for s in range(12)]
    assert first.count(0.0) >= 11  # nearly all the weight
    two = KM.starts(pts, 4, range(20))
    assert all(sorted(c[:, 0]) == sorted(x) for c in two) and w.sum() > 1000  # four points, none drawn twice


def test_odd_inputs(spark):
    assert KM.fit(KM.points(spark.createDataFrame([], "id int, x double"), ["x"]), [2, 3]) == []
    one = KM.fit(KM.points(spark.createDataFrame([(1, 5.0)] * 3, "id int, x double"), ["x"]), [2])[0]
    assert one.cost == 0 and one.centers.tolist() == [[5.0], [5.0]]
    z = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 9.0)], "listing_id int, x double")
    sweep = CL.kmeans_sweep(z, ["x"], ks=[2])
    assert sweep[0][:3] == (2, 0.0, pytest.approx(2 / 3)) and CL.best_k(sweep) == 2
    heavy = CL.fit_centers(spark.createDataFrame([("a", 0.0, 9.0), ("b", 1.0, 1.0), ("c", 10.0, 1.0)], "id string, x double, n double"), ["x"], 2, weight="n")
    assert sorted(heavy[:, 0]) == pytest.approx([0.1, 10.0])
