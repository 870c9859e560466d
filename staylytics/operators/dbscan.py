"""DBSCAN (C12) on 2-D points as grid joins and connected components, over all rows.

Same answer as the textbook algorithm (Euclidean distance, a point's own
row counts towards ``min_pts``, neighbours at distance <= eps): the same
core points, the same clusters of core points, the same noise. A border
point reachable from several clusters takes the smallest cluster label
(the sequential algorithm takes whichever it visits first).

Points go to square sub-cells of side g = eps / (2 sqrt 2), so any two
points in sub-cells at most one step apart (the 3x3 block) are within
eps ("definite" offsets) and no point further than 3 steps away can be
("possible" offsets: the 7x7 block). Work per phase, all as DataFrame
joins on the integer sub-cell key:

1. core points. Per sub-cell, L = points in definite neighbours and
   U = points in possible neighbours (counts only: map-side combined).
   L >= min_pts: every point is core; U < min_pts: none is. Otherwise
   the sub-cell holds fewer than min_pts points (it is its own definite
   neighbour) and each point counts its exact neighbours in the 40
   ambiguous sub-cells, against distinct coordinates with multiplicity.
2. clusters. Nodes are sub-cells holding a core point: their core points
   are within eps/2 of each other, so they share a cluster. Definite
   neighbours are joined outright; the components of that graph are
   computed first, and exact point distances are checked only between
   sub-cells at ambiguous offsets whose components still differ.
3. border points: non-core points (fewer than min_pts per sub-cell)
   check the core sub-cells around them.

Connected components: min-label propagation with pointer jumping until
no label changes, each round cut with a reliable checkpoint.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

R = 3


def _offsets() -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    definite, ambiguous = [], []
    for dx in range(-R, R + 1):
        for dy in range(-R, R + 1):
            (definite if abs(dx) <= 1 and abs(dy) <= 1 else ambiguous).append((dx, dy))
    return definite, ambiguous


DEFINITE, AMBIGUOUS = _offsets()


def _explode_offsets(offs: list[tuple[int, int]]):
    return F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offs]))


OFF = 2 ** 30


def _cid(sx, sy):
    """One positive long per sub-cell (coordinates within +-2^30)."""
    return F.shiftleft(sx.cast("long") + F.lit(OFF), 32) + (sy.cast("long") + F.lit(OFF))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): label = a node id shared by exactly the nodes of one component.

    ``nodes`` has column ``id``; ``edges`` has ``src``, ``dst`` (either direction).
    """
    e = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = cut_lineage(e.where(F.col("src") != F.col("dst")).distinct())
    lab = cut_lineage(nodes.select("id", F.col("id").alias("label")).distinct())
    while True:
        nb = e.join(lab.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.min("label").alias("m"))
        # written, so that both sides of the jump are plain scans: Spark then splits a label that most nodes carry
        step = cut_lineage(lab.join(nb.withColumnRenamed("src", "id"), "id", "left").select(
            "id", F.least("label", F.coalesce("m", "label")).alias("label")))
        a, b = step.alias("a"), step.alias("b")
        jumped = a.join(b, F.col("a.label") == F.col("b.id")).select(
            F.col("a.id").alias("id"), F.least(F.col("a.label"), F.col("b.label")).alias("label"))
        new = cut_lineage(jumped)
        changed = new.join(lab.withColumnRenamed("label", "old"), "id").where(F.col("label") != F.col("old")).count()
        lab = new
        if changed == 0:
            return lab


#: A cell's side is cut into so many for the next, finer look at a pair of cells, and so many looks are taken.
FINER, LOOKS = 16, 2


def _near_parts(pairs: DataFrame, coords: DataFrame, g: float, e2: float) -> DataFrame:
    """(src, dst): components la, lb of the cell pairs (a, b, la, lb) with a point of a within eps of one of b.

    Points meet as boxes first: the points of a cell are cut by a finer
    grid, and two boxes whose farthest corners are within eps are a link,
    two whose nearest sides are not are none. Only pairs of boxes in
    between are cut again, and only for components not linked so far; what
    is still open after the last look is compared point by point.
    """
    todo, links, h = pairs.select("a", "b", "la", "lb"), None, g
    keys: list[str] = []
    for look in range(LOOKS):
        h /= FINER
        fine = [f"cx{look}", f"cy{look}"]
        coords = coords.withColumn(fine[0], F.floor(F.col("x") / h)).withColumn(fine[1], F.floor(F.col("y") / h))
        box = cut_lineage(coords.groupBy("cid", *keys, *fine).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")))
        side = lambda s: box.select(*[F.col(c).alias(f"{s}_{c}") for c in box.columns])
        on = lambda s: [F.col(s) == F.col(f"{s}_cid")] + [F.col(f"p{s}_{k}") == F.col(f"{s}_{k}") for k in keys]
        t = todo.select("a", "b", "la", "lb", *[F.col(f"{s}_{k}").alias(f"p{s}_{k}") for s in "ab" for k in keys])
        gap = lambda z: F.greatest(F.col(f"a_{z}0") - F.col(f"b_{z}1"), F.col(f"b_{z}0") - F.col(f"a_{z}1"), F.lit(0.0))
        far = lambda z: F.greatest(F.col(f"a_{z}1") - F.col(f"b_{z}0"), F.col(f"b_{z}1") - F.col(f"a_{z}0"))
        near = gap("x") * gap("x") + gap("y") * gap("y") <= e2
        met = t.join(side("a"), on("a")).join(side("b"), [*on("b"), near])
        keys = keys + fine
        met = cut_lineage(met.select("a", "b", "la", "lb", (far("x") * far("x") + far("y") * far("y") <= e2).alias("linked"),
                                     *[f"{s}_{k}" for s in "ab" for k in keys]))
        sure = met.where("linked").select(F.col("la").alias("src"), F.col("lb").alias("dst")).distinct()
        links = cut_lineage(sure if links is None else links.unionByName(sure))
        todo = cut_lineage(met.where(~F.col("linked")).drop("linked").join(links, (F.col("la") == F.col("src")) & (F.col("lb") == F.col("dst")), "left_anti"))
    side = lambda s: coords.select(F.col("cid").alias(f"{s}_cid"), F.col("x").alias(f"{s}_x"), F.col("y").alias(f"{s}_y"),
                                   *[F.col(k).alias(f"q{s}_{k}") for k in keys])
    on = lambda s: [F.col(s) == F.col(f"{s}_cid")] + [F.col(f"{s}_{k}") == F.col(f"q{s}_{k}") for k in keys]
    close = (F.col("a_x") - F.col("b_x")) ** 2 + (F.col("a_y") - F.col("b_y")) ** 2 <= e2
    rest = todo.join(side("a"), on("a")).join(side("b"), [*on("b"), close]).select(F.col("la").alias("src"), F.col("lb").alias("dst")).distinct()
    return links.unionByName(rest).distinct()


def dbscan(points: DataFrame, id_col: str, x: str, y: str, eps: float, min_pts: int) -> DataFrame:
    """(id, label, is_core) for every point with both coordinates; label -1 = noise."""
    g = eps / (2 * math.sqrt(2)) * (1 - 1e-9)  # margin keeps "definite" strict under rounding
    e2 = eps * eps
    pts = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    pts = pts.select("*", F.floor(F.col("x") / g).alias("sx"), F.floor(F.col("y") / g).alias("sy"))
    sc = pts.groupBy("sx", "sy").agg(F.count(F.lit(1)).alias("n"))

    # phase 1: core points
    defs = set(DEFINITE)
    allo = DEFINITE + AMBIGUOUS
    arr = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"),
                                       F.lit((dx, dy) in defs).alias("d")) for dx, dy in allo]))
    spread = sc.select("sx", "sy", "n", arr.alias("o")).select(
        (F.col("sx") + F.col("o.dx")).alias("sx"), (F.col("sy") + F.col("o.dy")).alias("sy"),
        F.when(F.col("o.d"), F.col("n")).otherwise(F.lit(0)).alias("nd"), "n")
    bounds = spread.groupBy("sx", "sy").agg(F.sum("nd").alias("L"), F.sum("n").alias("U"))
    cls = sc.join(bounds, ["sx", "sy"]).select(
        "sx", "sy", "L", F.when(F.col("L") >= min_pts, "core").when(F.col("U") < min_pts, "none")
        .otherwise("amb").alias("cls"))
    p = cut_lineage(pts.join(cls, ["sx", "sy"]))

    coords = pts.groupBy("sx", "sy", "x", "y").agg(F.count(F.lit(1)).alias("c"))
    amb = p.where(F.col("cls") == "amb")
    probe = amb.select("id", "x", "y", "sx", "sy", _explode_offsets(AMBIGUOUS).alias("o")).select(
        "id", F.col("x").alias("px"), F.col("y").alias("py"),
        (F.col("sx") + F.col("o.dx")).alias("sx"), (F.col("sy") + F.col("o.dy")).alias("sy"))
    near = probe.join(coords, ["sx", "sy"]).where(
        (F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2 <= e2)
    extra = near.groupBy("id").agg(F.sum("c").alias("extra"))
    amb_core = amb.join(extra, "id", "left").select(
        "id", "x", "y", "sx", "sy", ((F.col("L") + F.coalesce("extra", F.lit(0))) >= min_pts).alias("is_core"))
    status = cut_lineage(p.where(F.col("cls") != "amb").select(
        "id", "x", "y", "sx", "sy", (F.col("cls") == "core").alias("is_core")).unionByName(amb_core))

    # phase 2: clusters of core sub-cells
    core = status.where("is_core")
    csc = core.groupBy("sx", "sy").agg(F.count(F.lit(1)).alias("k")).select("sx", "sy", _cid(F.col("sx"), F.col("sy")).alias("id"))
    csc = cut_lineage(csc)
    nbr = csc.select(F.col("id").alias("src"), "sx", "sy", _explode_offsets(DEFINITE).alias("o")).select(
        "src", (F.col("sx") + F.col("o.dx")).alias("sx"), (F.col("sy") + F.col("o.dy")).alias("sy"))
    def_edges = nbr.join(csc, ["sx", "sy"]).select("src", F.col("id").alias("dst"))
    lab1 = connected_components(csc.select("id"), def_edges)
    csc1 = csc.join(lab1.withColumnRenamed("label", "l1"), "id")
    # ambiguous sub-cell pairs in different first-pass components
    anbr = csc1.select(F.col("id").alias("a"), F.col("l1").alias("la"), "sx", "sy",
                       _explode_offsets(AMBIGUOUS).alias("o")).select(
        "a", "la", (F.col("sx") + F.col("o.dx")).alias("sx"), (F.col("sy") + F.col("o.dy")).alias("sy"))
    pairs = anbr.join(csc1, ["sx", "sy"]).where(F.col("la") < F.col("l1")).select(
        "a", F.col("id").alias("b"), "la", F.col("l1").alias("lb"))
    ccoords = core.groupBy("sx", "sy", "x", "y").agg(F.count(F.lit(1)).alias("c")).select(
        _cid(F.col("sx"), F.col("sy")).alias("cid"), "sx", "sy", "x", "y")
    amb_edges = _near_parts(cut_lineage(pairs.distinct()), ccoords.select("cid", "x", "y"), g, e2)
    lab2 = connected_components(lab1.select(F.col("label").alias("id")).distinct(), amb_edges)
    labels = cut_lineage(csc1.join(lab2.withColumnRenamed("id", "l1"), "l1").select("sx", "sy", "label"))

    core_out = core.join(labels, ["sx", "sy"]).select("id", "label", F.lit(True).alias("is_core"))

    # phase 3: border points
    nc = status.where(~F.col("is_core"))
    d_hit = nc.select("id", _explode_offsets(DEFINITE).alias("o"), "sx", "sy").select(
        "id", (F.col("sx") + F.col("o.dx")).alias("sx"), (F.col("sy") + F.col("o.dy")).alias("sy")) \
        .join(labels, ["sx", "sy"]).select("id", "label")
    lcoords = ccoords.join(labels, ["sx", "sy"]).select("sx", "sy", "x", "y", "label")
    a_probe = nc.select("id", F.col("x").alias("px"), F.col("y").alias("py"), "sx", "sy",
                        _explode_offsets(AMBIGUOUS).alias("o")).select(
        "id", "px", "py", (F.col("sx") + F.col("o.dx")).alias("sx"), (F.col("sy") + F.col("o.dy")).alias("sy"))
    a_hit = a_probe.join(lcoords, ["sx", "sy"]).where(
        (F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2 <= e2).select("id", "label")
    border = d_hit.unionByName(a_hit).groupBy("id").agg(F.min("label").alias("label"))
    nc_out = nc.join(border, "id", "left").select(
        "id", F.coalesce("label", F.lit(-1).cast("long")).alias("label"), F.lit(False).alias("is_core"))
    return core_out.unionByName(nc_out).withColumnRenamed("id", id_col)


def dbscan_summary(labels: DataFrame) -> DataFrame:
    """n_clusters, n_noise, noise % (2 digits), n_core, n_points."""
    return labels.agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_distinct(F.when(F.col("label") >= 0, F.col("label"))).alias("n_clusters"),
        F.count_if(F.col("label") < 0).alias("n_noise"),
        F.count_if("is_core").alias("n_core"),
    ).select("n_clusters", "n_noise",
             (F.round(F.col("n_noise") * 100.0 / F.col("n_points"), 2)).alias("noise_pct"),
             "n_core", "n_points")
