"""DBSCAN as grid joins against a brute-force numpy DBSCAN."""

import numpy as np
import pytest

from staylytics.operators.dbscan import connected_components, dbscan, dbscan_summary


def brute(xy, eps, min_pts):
    d2 = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_pts
    comp = -np.ones(len(xy), int)
    c = 0
    for i in np.where(core)[0]:
        if comp[i] >= 0:
            continue
        stack = [i]
        comp[i] = c
        while stack:
            j = stack.pop()
            for k in np.where(nb[j] & core)[0]:
                if comp[k] < 0:
                    comp[k] = c
                    stack.append(k)
        c += 1
    return core, comp, nb


def fixture(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.normal([0, 0], 0.15, (300, 2)),            # dense blob
             rng.normal([1.5, 1.0], 0.3, (150, 2)),         # looser blob
             np.column_stack([np.linspace(-2, 2, 60), np.full(60, -1.5)]),  # chain
             rng.uniform(-3, 3, (80, 2)),                    # noise
             np.repeat([[2.5, -2.5]], 20, axis=0)]           # duplicates
    return np.vstack(parts)


@pytest.mark.parametrize("seed,eps,min_pts", [(1, 0.4, 15), (3, 0.1, 4)])
def test_dbscan_matches_bruteforce(spark, seed, eps, min_pts):
    xy = fixture(seed)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, x double, y double")
    res = dbscan(df, "id", "x", "y", eps, min_pts).persist()
    out = {r["id"]: (r["label"], r["is_core"]) for r in res.collect()}
    assert len(out) == len(xy)
    core, comp, nb = brute(xy, eps, min_pts)
    got_core = np.array([out[i][1] for i in range(len(xy))])
    np.testing.assert_array_equal(got_core, core)
    # same partition of core points
    pairs = {}
    for i in np.where(core)[0]:
        pairs.setdefault(comp[i], set()).add(out[i][0])
    assert all(len(v) == 1 for v in pairs.values())
    assert len({next(iter(v)) for v in pairs.values()}) == len(pairs)
    lab_of_comp = {k: next(iter(v)) for k, v in pairs.items()}
    for i in np.where(~core)[0]:
        reach = {lab_of_comp[comp[j]] for j in np.where(nb[i] & core)[0]}
        if reach:
            assert out[i][0] == min(reach)
        else:
            assert out[i][0] == -1
    s = dbscan_summary(res).first()
    assert s["n_clusters"] == len(pairs)
    assert s["n_noise"] == sum(1 for i in range(len(xy)) if out[i][0] == -1)


def test_connected_components_path(spark):
    n = 40
    nodes = spark.range(n).select("id")
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, n - 1) if i != 19], "src long, dst long")
    lab = {r["id"]: r["label"] for r in connected_components(nodes, edges).collect()}
    assert len({lab[i] for i in range(20)}) == 1
    assert len({lab[i] for i in range(20, 40)}) == 1
    assert lab[0] != lab[39]


def test_connected_components_random_graph(spark):
    import random

    rnd = random.Random(1)
    ids = [rnd.randrange(1 << 40, 1 << 60) for _ in range(62)]
    edges = [(rnd.choice(ids), rnd.choice(ids)) for _ in range(77)]
    lab = {r["id"]: r["label"] for r in connected_components(
        spark.createDataFrame([(i,) for i in ids], "id long"),
        spark.createDataFrame(edges, "src long, dst long")).collect()}
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x

    for a, b in edges:
        par[find(a)] = find(b)
    groups = {}
    for i in ids:
        groups.setdefault(find(i), set()).add(lab[i])
    assert all(len(v) == 1 for v in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == len(groups)


@pytest.mark.parametrize("gap,together", [(0.15, True), (0.27, False)])
def test_two_dense_cells_at_an_ambiguous_offset(spark, gap, together):
    # 10,000 points in two cells that are linked, if at all, by their facing edges only
    eps = 0.4
    g = eps / (2 * np.sqrt(2))
    rng = np.random.default_rng(5)
    a = rng.uniform(0, 1, (5000, 2)) * [g * 0.2, g]
    b = rng.uniform(0, 1, (5000, 2)) * [g * 0.2, g] + [a[:, 0].max() + eps - 0.2 + gap, 0]
    xy = np.vstack([a, b])
    d = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double").repartition(4)
    near = min(np.hypot(*(b[k] - a).T).min() for k in np.argsort(b[:, 0])[:50]) <= eps
    assert near == together
    s = dbscan_summary(dbscan(d, "id", "x", "y", eps, 15)).first()
    assert (s["n_clusters"], s["n_noise"], s["n_core"]) == (1 if together else 2, 0, 10000)
