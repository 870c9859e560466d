"""Feature preparation (C1-C3): dummies, p99 clipping, standardisation.

Clip points are exact linear quantiles (``quantiles.exact_quantiles_multi``);
means and population standard deviations come from one aggregate. The
only values collected are a few scalars per column and the list of room
types (a small category set).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .describe import PRICE, RATE
from .quantiles import exact_quantiles_multi

CLUSTER_BASE = ["price", "avail", "minimum_nights", "total_reviews"]


def modelling_frame(dl: DataFrame) -> DataFrame:
    """Listings with price 1..2000 and a known availability rate."""
    d = dl.filter(F.col(PRICE).between(1, 2000) & F.col(RATE).isNotNull())
    return d.select("listing_id", "neighbourhood", "room_type", "latitude", "longitude",
                    F.col(PRICE).alias("price"), F.col(RATE).alias("avail"),
                    "minimum_nights", "total_reviews")


def dummy_name(level: str, prefix: str = "rt") -> str:
    return f"{prefix}_" + re.sub(r"[^0-9A-Za-z]+", "_", level).strip("_")


def levels(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null values of a categorical column; each becomes a column of the result's schema."""
    return [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, drop_first: bool = True, prefix: str = "rt",
            values: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """0/1 columns per level in alphabetical order; optionally drop the first level."""
    lv = values if values is not None else levels(df, col)
    keep = lv[1:] if drop_first else lv
    names = [dummy_name(v, prefix) for v in keep]
    return df.select("*", *[F.when(F.col(col) == v, 1.0).otherwise(0.0).alias(n)
                            for v, n in zip(keep, names)]), names


def clip_upper(df: DataFrame, cols: list[str], p: float = 0.99) -> DataFrame:
    """Clip each column at its exact p-quantile (upper only), then fill NULL with 0."""
    caps = {c: None for c in cols}
    for r in exact_quantiles_multi(df, cols, [p]).collect():  # one row per column
        caps[r["column"]] = r["value"]
    out = df
    for c in cols:
        x = F.col(c).cast("double")
        clipped = x if caps[c] is None else F.when(x > F.lit(caps[c]), F.lit(caps[c])).otherwise(x)
        out = out.withColumn(c, F.coalesce(clipped, F.lit(0.0)))
    return out


def standardise(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    exprs = []
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        z = F.lit(0.0) if not s else (F.col(c) - F.lit(m)) / F.lit(s)
        exprs.append(z.alias(c + suffix))
    keep = [x for x in df.columns if x not in cols or suffix]
    return df.select(*keep, *exprs)


def cluster_features(dl: DataFrame, room_types: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """C1 + C2: clipped base features plus room-type dummies (first level dropped)."""
    d = modelling_frame(dl)
    d = clip_upper(d, CLUSTER_BASE)
    d, dummies = one_hot(d, "room_type", drop_first=True, values=room_types)
    return d, CLUSTER_BASE + dummies
