"""Point in polygon (grid join + ray casting) against a plain even-odd reference."""

import math
import random

from staylytics.operators.geo import points_in_polygons, polygon_cells


def inside_ring_count(ring, x, y):
    c = 0
    for (xa, ya), (xb, yb) in zip(ring, ring[1:]):
        if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
            c += 1
    return c


def inside(multi, x, y):
    return any(sum(inside_ring_count(r, x, y) for r in poly) % 2 == 1 for poly in multi)


# a concave outer ring with a square hole, and a second polygon far away
CONCAVE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 1.5], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[0.5, 0.5], [1.5, 0.5], [1.5, 1.2], [0.5, 1.2], [0.5, 0.5]]
FAR = [[10.0, 10.0], [11.0, 10.0], [10.5, 11.0], [10.0, 10.0]]
TRI = [[3.0, 3.0], [6.0, 3.5], [3.5, 6.0], [3.0, 3.0]]


def test_random_points_match_reference(spark):
    polys = {"A": [[CONCAVE, HOLE], [FAR]], "B": [[TRI]]}
    nb = spark.createDataFrame([(k, v) for k, v in polys.items()],
                               "neighbourhood string, neighbourhood_boundary array<array<array<array<double>>>>")
    rnd = random.Random(4)
    pts = [(i, rnd.uniform(-1, 12), rnd.uniform(-1, 12)) for i in range(3000)]
    pts += [(3000 + i, float(x), float(y)) for i, (x, y) in enumerate([(2.0, 1.5), (1.0, 0.85), (10.5, 10.2)])]
    df = spark.createDataFrame(pts, "pid long, lon double, lat double")
    got = {(r["pid"], r["neighbourhood_in_boundary"])
           for r in points_in_polygons(df, "lon", "lat", nb, "pid").collect()}
    want = {(i, k) for i, x, y in pts for k, m in polys.items() if inside(m, x, y)}
    want |= {(i, None) for i in {p[0] for p in pts} - {i for i, _ in want}}   # in no polygon
    assert got == want
    assert (3001, "A") not in got          # inside the hole
    assert (3002, "A") in got              # inside the far polygon


SHAPE = "neighbourhood string, neighbourhood_boundary array<array<array<array<double>>>>"


def star(x, y, size, n):
    """A ring of n vertices with ten spikes."""
    out = []
    for i in range(n):
        t = 2 * math.pi * i / n
        out.append([x + size * (1 + 0.5 * math.sin(10 * t)) * math.cos(t), y + size * (1 + 0.5 * math.sin(10 * t)) * math.sin(t)])
    return [*out, out[0]]


def test_cells_follow_the_border_at_every_size(spark):
    # the same outline as large as a country and as a house
    polys = {"country": [[star(10.3, 45.7, 9.0, 2000)]], "house": [[star(-3.21, 51.47, 1e-4, 2000)]]}
    nb = spark.createDataFrame(list(polys.items()), SHAPE)
    n = {d: {r[0]: (r[1], r[2]) for r in polygon_cells(nb, "neighbourhood", "neighbourhood_boundary", d).groupBy("neighbourhood").agg(
        {"*": "count", "inner": "bool_or"}).select("neighbourhood", "count(1)", "bool_or(inner)").collect()} for d in (6, 7, 8)}
    for k in polys:
        assert n[6][k][0] < 1000 and n[6][k][1] and n[8][k][0] < 2.6 * n[7][k][0]  # four times as many by area
    rnd = random.Random(6)
    pts = [(i, rnd.uniform(-4, 25), rnd.uniform(30, 60)) for i in range(1500)]
    pts += [(2000 + i, -3.21 + rnd.uniform(-2e-4, 2e-4), 51.47 + rnd.uniform(-2e-4, 2e-4)) for i in range(1500)]
    df = spark.createDataFrame(pts, "pid long, lon double, lat double")
    got = {(r["pid"], r["neighbourhood_in_boundary"]) for r in points_in_polygons(df, "lon", "lat", nb, "pid").collect() if r[-1]}
    assert got == {(i, k) for i, x, y in pts for k, m in polys.items() if inside(m, x, y)}


def test_inner_cells_meet_no_boundary(spark):
    nb = spark.createDataFrame([("A", [[CONCAVE, HOLE], [FAR]])], SHAPE)
    cells = polygon_cells(nb, "neighbourhood", "neighbourhood_boundary").collect()
    area = sum(4.0 ** -c["level"] for c in cells if c["inner"])
    assert 0.8 * 10.8 < area < 10.8  # of 11 - 0.7 + 0.5, in inner cells
    for c in cells:
        s = 2.0 ** -c["level"]
        at = [inside([[CONCAVE, HOLE], [FAR]], (c["cx"] + i / 7) * s, (c["cy"] + j / 7) * s) for i in range(7) for j in range(7)]
        assert not c["inner"] or all(at)


def test_odd_polygons_and_points(spark):
    flat = [[[[1.0, 1.0], [1.0, 1.0]]]]
    nb = spark.createDataFrame([("flat", flat), ("none", None), ("empty", []), (None, [[TRI]]), ("T", [[TRI]])], SHAPE)
    df = spark.createDataFrame([(1, 4.0, 4.0), (2, None, 4.0), (3, float("nan"), 4.0), (4, float("inf"), 4.0), (5, 1.0, 1.0), (6, 4.0, 4.0)],
                               "pid long, lon double, lat double")
    got = {r["pid"]: r["neighbourhood_in_boundary"] for r in points_in_polygons(df, "lon", "lat", nb, "pid").collect()}
    assert got == {1: "T", 2: None, 3: None, 4: None, 5: None, 6: "T"}
    none = points_in_polygons(df, "lon", "lat", nb.where("false"), "pid").collect()
    assert len(none) == 6 and all(r["neighbourhood_in_boundary"] is None for r in none)
    assert points_in_polygons(df.where("false"), "lon", "lat", nb, "pid").count() == 0
