"""PCA (pyspark.ml) and K-Means (kmeans.py) over all rows.

The points are persisted while the models of a sweep are fitted together.
Cluster ids are arbitrary in K-Means; every output renumbers clusters
by ascending mean price so results are stable across seeds.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_away
from ..session import cut_lineage
from . import features as FT
from . import kmeans as KM
from . import silhouette as SL


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


# ---- PCA ------------------------------------------------------------------

class PcaResult:
    def __init__(self, scores: DataFrame, components: np.ndarray, ratio: np.ndarray,
                 eigenvalues: np.ndarray, cols: list[str]):
        self.scores, self.components, self.ratio = scores, components, ratio
        self.eigenvalues, self.cols = eigenvalues, cols


def pca(df: DataFrame, cols: list[str], k: int = 2, id_cols: tuple[str, ...] = ("listing_id",)) -> PcaResult:
    """C4/C5 on already standardised columns.

    Signs are fixed so that each component's largest absolute loading is
    positive. Eigenvalues use the sample covariance (as the reference's
    explained variance does): ratio * sum of column sample variances.
    """
    a = assemble(df, cols)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(a)
    comps = model.pc.toArray()  # d x k
    signs = np.array([1.0 if comps[np.argmax(np.abs(comps[:, j])), j] >= 0 else -1.0 for j in range(k)])
    comps = comps * signs
    ratio = np.array(model.explainedVariance.toArray())
    total = df.agg(*[F.var_samp(c) for c in cols]).first()
    eig = ratio * float(sum(v or 0.0 for v in total))
    t = model.transform(a).withColumn("pcs_arr", vector_to_array(F.col("pcs")))
    scores = t.select(*id_cols, *[(F.col("pcs_arr")[j] * float(signs[j])).alias(f"pc{j + 1}")
                                  for j in range(k)])
    return PcaResult(scores, comps, ratio, eig, cols)


def pca_loadings(res: PcaResult) -> list[tuple]:
    load = res.components * np.sqrt(res.eigenvalues)[None, :]
    return [(c, float(load[i, 0]), float(load[i, 1])) for i, c in enumerate(res.cols)]


def multivariate_frame(dl: DataFrame) -> tuple[DataFrame, list[str]]:
    """Features of the multivariate PCA: price, min nights, reviews, availability; no clip."""
    d = FT.modelling_frame(dl).select(
        "listing_id", "room_type",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
          for c in ["price", "minimum_nights", "total_reviews", "avail"]])
    cols = ["price", "minimum_nights", "total_reviews", "avail"]
    return FT.standardise(d, cols), cols


# ---- K-Means ----------------------------------------------------------------

def scaled_cluster_frame(dl: DataFrame, room_types: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Clipped, dummy-coded, standardised features (columns prefixed z_)."""
    d, cols = FT.cluster_features(dl, room_types)
    z = FT.standardise(d, cols, suffix="_z")
    return z, [c + "_z" for c in cols]


class SweepRow(NamedTuple):
    """The best of the restarts for one K; the Euclidean silhouette lies between ``low`` and ``high``, from the cells of ``tree``."""

    k: int
    inertia: float
    silhouette: float
    low: float
    high: float
    tree: SL.Tree
    silhouette_sq: float
    centers: np.ndarray


def kmeans_sweep(z: DataFrame, cols: list[str], ks=range(2, 11), seeds=KM.SEEDS) -> list[SweepRow]:
    """Inertia and both silhouettes of the best of the restarts for each k, over all rows."""
    pts = KM.points(z, cols).persist()
    try:
        models = KM.fit(pts, ks, seeds)
        if not models:
            return []
        squared = KM.silhouettes(pts, models)
        return [SweepRow(m.k, m.cost, *s, q, m.centers) for m, s, q in zip(models, SL.of_models(pts, models), squared)]
    finally:
        pts.unpersist()


def fit_centers(df: DataFrame, cols: list[str], k: int, seeds=KM.SEEDS, weight: str | None = None) -> np.ndarray:
    """Centres of the best of the restarts (C7). ``weight`` names a column that says how many rows a row stands for."""
    pts = KM.points(df, cols, weight).persist()
    try:
        models = KM.fit(pts, [k], seeds)
    finally:
        pts.unpersist()
    return models[0].centers if models else np.zeros((1, len(cols)))


def best_k(sweep: list[SweepRow]) -> int:
    """First k with the maximum Euclidean silhouette."""
    top = max(row.silhouette for row in sweep)
    return next(row.k for row in sweep if row.silhouette == top)


def price_order(pred: DataFrame, price_col: str = "price") -> list[int]:
    """Raw cluster ids sorted by ascending mean price (k rows collected)."""
    return [r["cluster"] for r in pred.groupBy("cluster").agg(F.avg(price_col).alias("m"))
            .orderBy("m", "cluster").collect()]


def relabel(pred: DataFrame, order: list[int]) -> DataFrame:
    """Renumber clusters so that raw id ``order[i]`` becomes ``i``."""
    mapping = F.create_map(*[x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i))])
    return pred.withColumn("cluster", mapping[F.col("cluster")])


def relabel_by_price(pred: DataFrame, price_col: str = "price") -> DataFrame:
    """Renumber clusters 0..k-1 by ascending mean price."""
    return relabel(pred, price_order(pred, price_col))


class FinalClusters:
    def __init__(self, pred: DataFrame, raw: np.ndarray, order: list[int]):
        self.pred, self.raw, self.order = pred, raw, order

    def centers(self) -> list[np.ndarray]:
        """Cluster centres indexed by the relabelled id."""
        return [self.raw[c] for c in self.order]


def final_clusters(z: DataFrame, cols: list[str], centers: np.ndarray) -> FinalClusters:
    """All rows labelled by the centres of the chosen fit; the labelled rows are written."""
    raw = cut_lineage(KM.assign(z, cols, centers))
    order = price_order(raw)
    return FinalClusters(relabel(raw, order), centers, order)


def silhouette_rows(pred: DataFrame, cols: list[str]) -> DataFrame:
    """Per-row silhouette with squared Euclidean distance, exactly, over all rows.

    Mean squared distance from x to cluster C is |x|^2 - 2 x.mean_C + mean_C(|y|^2),
    so k cluster summaries (count, mean vector, mean squared norm) suffice.
    """
    norm2 = sum(F.col(c) * F.col(c) for c in cols)
    stats = pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(norm2).alias("s"),
                                        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).collect()
    dist = {}
    for r in stats:
        dot = sum(F.col(c) * F.lit(float(r[f"m{i}"])) for i, c in enumerate(cols))
        dist[r["cluster"]] = (norm2 - 2 * dot + F.lit(float(r["s"])), int(r["n"]))
    # flat coalesce / least over k branches (no nested CASE chain, which outgrows codegen)
    own = F.coalesce(*[F.when(F.col("cluster") == c, d * n / (n - 1) if n > 1 else F.lit(0.0))
                       for c, (d, n) in dist.items()])
    other = F.least(*[F.when(F.col("cluster") != c, d) for c, (d, _) in dist.items()], F.lit(None).cast("double"))
    size = F.coalesce(*[F.when(F.col("cluster") == c, F.lit(n)) for c, (_, n) in dist.items()])
    s = F.when(size <= 1, F.lit(0.0)).otherwise(F.try_divide(other - own, F.greatest(own, other)))
    return pred.select("*", s.alias("silhouette_sq_euclidean"))


def cluster_profile(pred: DataFrame, raw_cols=("price", "avail", "minimum_nights", "total_reviews")) -> DataFrame:
    """Mean raw feature per cluster (2 digits) and its z-score across clusters (sample std)."""
    prof = pred.groupBy("cluster").agg(*[round_half_away(F.avg(c), 2).alias(c) for c in raw_cols])
    s = prof.agg(*[F.avg(c).alias(f"m_{c}") for c in raw_cols],
                 *[F.stddev_samp(c).alias(f"s_{c}") for c in raw_cols]).first()
    return prof.select("cluster", *raw_cols, *[
        F.try_divide(F.col(c) - F.lit(s[f"m_{c}"]), F.lit(s[f"s_{c}"])).alias(f"{c}_z") for c in raw_cols])


def cluster_room_share(pred: DataFrame) -> DataFrame:
    """Room type % within each cluster, one decimal; every cluster has every room type (0 where it has none)."""
    counts = cut_lineage(pred.groupBy("cluster", "room_type").agg(F.count(F.lit(1)).alias("n")))
    types = F.array(*[F.lit(r[0]) for r in counts.select("room_type").distinct().orderBy(F.asc_nulls_last("room_type")).collect()])
    tot = counts.groupBy("cluster").agg(F.sum("n").alias("tot"))
    cells = tot.select("cluster", "tot", F.explode(types).alias("room_type")).alias("a")
    c = counts.alias("c")
    same = F.col("a.cluster").eqNullSafe(F.col("c.cluster")) & F.col("a.room_type").eqNullSafe(F.col("c.room_type"))
    return cells.join(c, same, "left").select(
        "a.cluster", "a.room_type", round_half_away(F.coalesce("c.n", F.lit(0)) * 100.0 / F.col("a.tot"), 1).alias("pct"))
