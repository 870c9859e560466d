"""Feature, PCA and clustering queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..operators import features as FT
from ..operators import kmeans as KM
from ..operators import silhouette as SL
from ..oracle import oracle, r
from ..registry import Ctx, query
from ..session import cut_lineage
from .analysis import TEST_ROOM_TYPES

P = "avg_price_next_30_days"
RATE = "availability_rate_next_30_days"
DUMMIES = [FT.dummy_name(t) for t in TEST_ROOM_TYPES[1:]]
BASE = FT.CLUSTER_BASE


def _features(c: Ctx):
    return c.once("cluster_features", lambda: FT.cluster_features(c["dim_listings"]))


def _scaled(c: Ctx):
    return c.once("scaled", lambda: CL.scaled_cluster_frame(c["dim_listings"]))


@query("cluster_features")
def q_cluster_features(c: Ctx):
    """C1 + C2: p99-clipped features and room-type dummies (first level dropped)."""
    d, cols = _features(c)
    return d.select("listing_id", *cols)


FEATURES_SQL = f"""
, m AS (SELECT listing_id, room_type, {P} AS price, {RATE} AS avail,
               CAST(minimum_nights AS DOUBLE) AS minimum_nights, CAST(total_reviews AS DOUBLE) AS total_reviews
        FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 AND {RATE} IS NOT NULL),
cap AS (SELECT """ + ", ".join(f"quantile_cont({b}, 0.99) AS cap_{b}" for b in BASE) + """ FROM m),
f AS (SELECT listing_id, """ + ", ".join(
    f"COALESCE(CASE WHEN {b} > cap_{b} THEN cap_{b} ELSE {b} END, 0.0e0) AS {b}" for b in BASE) + ", " + ", ".join(
    f"CASE WHEN room_type = '{t}' THEN 1.0e0 ELSE 0.0e0 END AS {n}"
    for t, n in zip(TEST_ROOM_TYPES[1:], DUMMIES)) + """ FROM m, cap)
"""

oracle("cluster_features", FEATURES_SQL + "SELECT * FROM f", BASE + DUMMIES)


@query("scaled_features")
def q_scaled_features(c: Ctx):
    """Population-std standardisation of the cluster features."""
    z, cols = _scaled(c)
    return z.select("listing_id", *cols)


oracle("scaled_features", FEATURES_SQL + "SELECT listing_id, " + ", ".join(
    f"CASE WHEN stddev_pop({x}) OVER () = 0 THEN 0.0e0 "
    f"ELSE ({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER () END AS {x}_z" for x in BASE + DUMMIES)
       + " FROM f", [x + "_z" for x in BASE + DUMMIES])


def _pca_multi(c: Ctx):
    def fit():
        d, cols = CL.multivariate_frame(c["dim_listings"])
        return CL.pca(d, cols)
    return c.once("pca_multi", fit)


def _pca_cluster(c: Ctx):
    def fit():
        z, cols = _scaled(c)
        return CL.pca(z, cols)
    return c.once("pca_cluster", fit)


@query("pca_variance")
def q_pca_variance(c: Ctx):
    """C4: explained variance ratio of two components, for both feature sets."""
    rows = [("multivariate", j + 1, float(v)) for j, v in enumerate(_pca_multi(c).ratio)]
    rows += [("clustering", j + 1, float(v)) for j, v in enumerate(_pca_cluster(c).ratio)]
    return c.spark.createDataFrame(rows, "feature_set string, component int, explained_ratio double")


@query("pca_scores")
def q_pca_scores(c: Ctx):
    """C4: PC1/PC2 score per listing (multivariate feature set)."""
    return _pca_multi(c).scores


@query("pca_price_availability")
def q_pca_price_availability(c: Ctx):
    """C4 on two columns, where it has a closed form."""
    d = FT.modelling_frame(c["dim_listings"]).select("listing_id", "price", "avail")
    res = CL.pca(FT.standardise(d, ["price", "avail"]), ["price", "avail"])
    return c.spark.createDataFrame([(j + 1, float(v)) for j, v in enumerate(res.ratio)], "component int, explained_ratio double")


oracle("pca_price_availability", f"""
SELECT CAST(j AS INTEGER) AS component, (1 + CASE WHEN j = 1 THEN 1 ELSE -1 END * abs(corr({P}, {RATE}))) / 2 AS explained_ratio
FROM dim_listings, (VALUES (1), (2)) AS v(j) WHERE {P} BETWEEN 1 AND 2000 AND {RATE} IS NOT NULL GROUP BY j""", ["explained_ratio"])


@query("pca_loadings")
def q_pca_loadings(c: Ctx):
    """loadings = component x sqrt(eigenvalue)."""
    return c.spark.createDataFrame(CL.pca_loadings(_pca_multi(c)), "feature string, pc1 double, pc2 double")


def _sweep(c: Ctx):
    return c.once("sweep", lambda: CL.kmeans_sweep(*_scaled(c)))


@query("kmeans_sweep")
def q_kmeans_sweep(c: Ctx):
    """Inertia and silhouettes for K = 2..10; best K by the Euclidean one flagged (first maximum), which lies between its bounds."""
    sw = _sweep(c)
    bk = CL.best_k(sw)
    return c.spark.createDataFrame(
        [(m.k, m.inertia, m.silhouette, m.low, m.high, m.silhouette_sq, m.k == bk) for m in sw],
        "k int, inertia double, " + ", ".join(f"{x} double" for x in SL.COLUMNS) + ", silhouette_sq_euclidean double, is_best boolean")


def _final(c: Ctx):
    def fit():
        z, cols = _scaled(c)
        sw = _sweep(c)
        bk = CL.best_k(sw)
        return CL.final_clusters(z, cols, next(m.centers for m in sw if m.k == bk)), cols
    return c.once("final", fit)


@query("kmeans_sizes")
def q_kmeans_sizes(c: Ctx):
    """Cluster sizes of the best-of-10-restarts model."""
    return _final(c)[0].pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


@query("silhouette_by_cluster")
def q_silhouette_by_cluster(c: Ctx):
    """Per-row silhouettes (Euclidean with its bounds, squared Euclidean), averaged per cluster and overall."""
    fc, cols = _final(c)
    sw = _sweep(c)
    s = SL.rows(CL.silhouette_rows(fc.pred, cols), cols, tree=next(m.tree for m in sw if m.k == CL.best_k(sw)))
    return _silhouettes(s, *SL.COLUMNS)


def _silhouettes(s, *more):
    means = [F.avg(x).alias(x) for x in ("silhouette_sq_euclidean", *more)]
    per = s.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *means)
    return per.unionByName(s.agg(F.lit(-1).alias("cluster"), F.count(F.lit(1)).alias("n"), *means))


@query("cluster_profile")
def q_cluster_profile(c: Ctx):
    """C9."""
    return CL.cluster_profile(_final(c)[0].pred)


@query("cluster_room_share")
def q_cluster_room_share(c: Ctx):
    """C10."""
    return CL.cluster_room_share(_final(c)[0].pred)


@query("cluster_centroids")
def q_cluster_centroids(c: Ctx):
    """C11: K-Means centres projected onto the clustering PCA plane."""
    fc, _ = _final(c)
    comps = _pca_cluster(c).components
    rows = []
    for i, ctr in enumerate(fc.centers()):
        xy = ctr @ comps
        rows.append((i, float(xy[0]), float(xy[1])))
    return c.spark.createDataFrame(rows, "cluster int, pc1 double, pc2 double")


def _neighbourhood_clusters(c: Ctx):
    def fit():
        cols = ["avg_price_usd", "total_listings", "total_hosts", "min_price_usd", "max_price_usd"]
        dn = c["dim_neighbourhoods"].select(
            "neighbourhood", *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in cols])
        z = FT.standardise(dn, cols, suffix="_z")
        zs = [x + "_z" for x in cols]
        raw = cut_lineage(KM.assign(z, zs, CL.fit_centers(z, zs, 3, tuple(range(42, 62)))))
        return CL.relabel_by_price(raw, "avg_price_usd")
    return c.once("neighbourhood_clusters", fit)


@query("neighbourhood_clusters")
def q_neighbourhood_clusters(c: Ctx):
    """K=3 on five standardised neighbourhood measures: profile of each cluster."""
    return _neighbourhood_clusters(c).groupBy("cluster").agg(
        F.round(F.avg("avg_price_usd"), 1).alias("avg_price_usd"),
        F.round(F.avg("total_listings"), 1).alias("total_listings"),
        F.round(F.avg("total_hosts"), 1).alias("total_hosts"), F.count(F.lit(1)).alias("n_members"))


@query("neighbourhood_cluster_members")
def q_neighbourhood_cluster_members(c: Ctx):
    """A row for each member of each cluster."""
    return _neighbourhood_clusters(c).select("cluster", "neighbourhood")


@query("room_type_clusters")
def q_room_type_clusters(c: Ctx):
    """C14: clusters of located listings from full room-type one-hot only (for the map).

    Listings of a room type are one point, so the fit sees each type once
    with its number of listings as weight. Clusters are numbered by their least room type.
    """
    d = c["dim_listings"].filter(F.col("latitude").isNotNull())
    types = cut_lineage(d.groupBy("room_type").agg(F.count(F.lit(1)).cast("double").alias("n")))
    oh, names = FT.one_hot(types, "room_type", drop_first=False, prefix="is")
    total = F.lit(types.agg(F.sum("n")).first()[0] or 1.0)
    share = types.select("room_type", (F.col("n") / total).alias("share")).collect()  # a row for each room type
    sd = {FT.dummy_name(r["room_type"], "is"): (r["share"], float(np.sqrt(r["share"] * (1 - r["share"])))) for r in share if r["room_type"] is not None}
    z = oh.select("room_type", "n", *[((F.col(x) - sd[x][0]) / sd[x][1] if sd[x][1] else F.lit(0.0)).alias(x + "_z") for x in names])
    zs = [n + "_z" for n in names]
    k = min(CL.best_k(_sweep(c)), len(share))
    pred = cut_lineage(KM.assign(z, zs, CL.fit_centers(z, zs, k, weight="n")).select("room_type", "cluster"))
    first = pred.groupBy("cluster").agg(F.min("room_type").alias("first")).orderBy(F.asc_nulls_last("first")).collect()
    of = CL.relabel(pred, [r["cluster"] for r in first])
    return d.join(of, d["room_type"].eqNullSafe(of["room_type"]), "left").select("listing_id", "latitude", "longitude", d["room_type"], "cluster")


def _by_room_type(c: Ctx):
    """The scaled listings with their room type as cluster, in alphabetical order: a labelling that SQL has too."""
    z, cols = _scaled(c)
    number = F.array(*[F.lit(t) for t in TEST_ROOM_TYPES])
    return z.withColumn("cluster", (F.array_position(number, F.col("room_type")) - 1).cast("int")), cols


TYPE_NUMBER = "CASE room_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TEST_ROOM_TYPES)) + " END"
Z = [x + "_z" for x in BASE + DUMMIES]
LABELLED_SQL = FEATURES_SQL.rstrip() + f""",
z AS (SELECT f.listing_id, room_type, {TYPE_NUMBER} AS cluster, {", ".join(f"f.{b} AS {b}" for b in BASE)}, {", ".join(
    f"CASE WHEN stddev_pop(f.{x}) OVER () = 0 THEN 0.0e0 ELSE (f.{x} - avg(f.{x}) OVER ()) / stddev_pop(f.{x}) OVER () END AS {x}_z"
    for x in BASE + DUMMIES)}
  FROM f JOIN m ON f.listing_id = m.listing_id)
"""


@query("silhouette_by_room_type")
def q_silhouette_by_room_type(c: Ctx):
    """C8 on a given labelling: squared-Euclidean silhouette with the room type as cluster."""
    z, cols = _by_room_type(c)
    return _silhouettes(CL.silhouette_rows(z, cols))


_NORM = " + ".join(f"{x} * {x}" for x in Z)
oracle("silhouette_by_room_type", LABELLED_SQL.rstrip() + f""",
pairs AS (SELECT a.listing_id, a.cluster, b.cluster AS other, sum({" + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in Z)}) AS d, count(*) AS n
          FROM z a JOIN z b ON a.listing_id <> b.listing_id GROUP BY a.listing_id, a.cluster, b.cluster),
s AS (SELECT listing_id, cluster, max(CASE WHEN other = cluster THEN d / n END) AS own, min(CASE WHEN other <> cluster THEN d / n END) AS near
      FROM pairs GROUP BY listing_id, cluster),
r AS (SELECT cluster, CASE WHEN own IS NULL THEN 0.0e0 ELSE (near - own) / greatest(own, near) END AS silhouette_sq_euclidean FROM s)
SELECT cluster, count(*) AS n, avg(silhouette_sq_euclidean) AS silhouette_sq_euclidean FROM r GROUP BY cluster
UNION ALL SELECT -1, count(*), avg(silhouette_sq_euclidean) FROM r""", ["silhouette_sq_euclidean"])


@query("profile_by_room_type")
def q_profile_by_room_type(c: Ctx):
    """C9 on a given labelling."""
    return CL.cluster_profile(_by_room_type(c)[0])


oracle("profile_by_room_type", LABELLED_SQL.rstrip() + """,
p AS (SELECT cluster, """ + ", ".join(f"{r(f'avg({b})', 2)} AS {b}" for b in BASE) + """ FROM z GROUP BY cluster)
SELECT cluster, """ + ", ".join(BASE) + ", " + ", ".join(
    f"CASE WHEN stddev_samp({b}) OVER () = 0 THEN NULL ELSE ({b} - avg({b}) OVER ()) / stddev_samp({b}) OVER () END AS {b}_z" for b in BASE)
       + " FROM p", BASE + [b + "_z" for b in BASE])


@query("room_share_by_price_band")
def q_room_share_by_price_band(c: Ctx):
    """C10 / A20 on a given labelling: bands of 100 of the clipped price as clusters, empty cells 0."""
    d, _ = _features(c)
    return CL.cluster_room_share(d.withColumn("cluster", F.floor(F.col("price") / 100).cast("int")))


oracle("room_share_by_price_band", FEATURES_SQL.rstrip() + f""",
b AS (SELECT CAST(floor(f.price / 100) AS INTEGER) AS cluster, room_type FROM f JOIN m ON f.listing_id = m.listing_id),
t AS (SELECT cluster, count(*) AS tot FROM b GROUP BY cluster),
n AS (SELECT cluster, room_type, count(*) AS n FROM b GROUP BY cluster, room_type),
y AS (SELECT DISTINCT room_type FROM b)
SELECT t.cluster, y.room_type, {r("COALESCE(n.n, 0) * 100.0e0 / t.tot", 1)} AS pct
FROM t CROSS JOIN y LEFT JOIN n ON n.cluster = t.cluster AND n.room_type IS NOT DISTINCT FROM y.room_type""", ["pct"])


@query("dbscan_summary")
def q_dbscan_summary(c: Ctx):
    """DBSCAN (eps 0.4, min 15) on the clustering PCA scores: clusters, noise, noise %."""
    from ..operators.dbscan import dbscan, dbscan_summary

    scores = _pca_cluster(c).scores
    return dbscan_summary(dbscan(scores, "listing_id", "pc1", "pc2", 0.4, 15))


EPS, MIN_PTS = 0.0035, 6


@query("dbscan_locations")
def q_dbscan_locations(c: Ctx):
    """C12 on the listings' coordinates: clusters, noise, noise %, core points."""
    from ..operators.dbscan import dbscan, dbscan_summary

    return dbscan_summary(dbscan(c["dim_listings"], "listing_id", "longitude", "latitude", EPS, MIN_PTS))


oracle("dbscan_locations", f"""
, p AS (SELECT row_number() OVER (ORDER BY listing_id) AS i, longitude AS x, latitude AS y FROM dim_listings),
near AS (SELECT a.i AS a, b.i AS b FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}e0 * {EPS}e0),
core AS (SELECT a AS i FROM near GROUP BY a HAVING count(*) >= {MIN_PTS}),
edge AS (SELECT a, b FROM near WHERE a IN (SELECT i FROM core) AND b IN (SELECT i FROM core)),
least AS (SELECT a.i, min(r.root) AS root FROM core a JOIN (
  WITH RECURSIVE reach(root, i) AS (SELECT i, i FROM core UNION SELECT root, b FROM reach JOIN edge ON edge.a = reach.i)
  SELECT * FROM reach) r ON r.i = a.i GROUP BY a.i),
t AS (SELECT count(*) AS n_points, count_if(i NOT IN (SELECT i FROM core) AND i NOT IN (SELECT a FROM near WHERE b IN (SELECT i FROM core))) AS n_noise FROM p)
SELECT (SELECT count(DISTINCT root) FROM least) AS n_clusters, CAST(n_noise AS BIGINT) AS n_noise,
       {r("n_noise * 100.0e0 / n_points", 2)} AS noise_pct, (SELECT count(*) FROM core) AS n_core, n_points FROM t""", ["noise_pct"])
