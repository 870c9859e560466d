"""Results do not depend on partitioning (shuffle partitions 1 vs 8, input 1 vs 8 partitions)."""

import numpy as np
import pytest

from staylytics.operators import anova as A
from staylytics.operators.quantiles import exact_quantiles


def frame(spark):
    rng = np.random.default_rng(11)
    g = rng.choice(["a", "b", "c", "d"], 3000, p=[0.4, 0.3, 0.2, 0.1])
    y = np.round(rng.normal(4.0, 0.5, 3000), 2)
    y[:1000] = 4.0                     # a third of all rows share one value
    return spark.createDataFrame([(str(a), float(b)) for a, b in zip(g, y)], "g string, y double")


def kruskal_reference(df):
    """Tie-corrected H from pandas average ranks."""
    pdf = df.toPandas()
    r = pdf["y"].rank(method="average")
    n = len(pdf)
    h = 12.0 / (n * (n + 1)) * sum(r[pdf.g == k].sum() ** 2 / (pdf.g == k).sum() for k in pdf.g.unique()) \
        - 3 * (n + 1)
    t = pdf["y"].value_counts().to_numpy().astype(float)
    return h / (1 - (t ** 3 - t).sum() / (n ** 3 - n))


@pytest.mark.parametrize("shuffle,inputs", [(1, 1), (8, 8), (3, 5)])
def test_kruskal_anova_quantiles_invariant(spark, shuffle, inputs):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
    try:
        df = frame(spark).repartition(inputs)
        h = A.kruskal(df).first()["h"]
        assert h == pytest.approx(kruskal_reference(df), rel=1e-10)
        t = A.anova_table(df).first()
        ys = df.toPandas()
        grand = ys.y.mean()
        ssb = sum(len(v) * (v.y.mean() - grand) ** 2 for _, v in ys.groupby("g"))
        assert t["ssb"] == pytest.approx(ssb, rel=1e-9)
        q = {r["prob"]: r["value"] for r in exact_quantiles(df, "y", [0.1, 0.5, 0.9]).collect()}
        for p in (0.1, 0.5, 0.9):
            assert q[p] == pytest.approx(float(np.percentile(ys.y, p * 100)), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
