"""Descriptive analysis (E1-E34): univariate, bivariate and multivariate frames.

Every statistic runs over all qualifying rows. Quantiles, whole or by
group, are exact at any size (``operators.quantiles``): no group gathers
its values in one task.
Small results are ordered; row-level results are left unordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import capped, nullif_zero, round_half_away, safe_corr
from .quantiles import group_quantiles, quantile_row

PRICE = "avg_price_next_30_days"
RATE = "availability_rate_next_30_days"

# fixed values: labels of the price quintiles
QUINTILE_LABELS = ["Q1 cheapest", "Q2", "Q3", "Q4", "Q5 priciest"]


def _with_quantiles(d: DataFrame, keys: list[str], col: str, probs: dict[str, float], aggs: list, digits: int | None = 2) -> DataFrame:
    """``aggs`` by group and the named exact quantiles of ``col``, rounded to ``digits`` (None: as they are)."""
    base, q = d.groupBy(*keys).agg(*aggs), group_quantiles(d, keys, col, probs)
    kind = d.schema[col].dataType
    fix = lambda c: round_half_away(c, digits) if digits is not None else c.cast(kind)
    if not keys:
        row = q.first()  # a few scalars
        return base.select("*", *[fix(F.lit(row[n] if row else None).cast("double")).alias(n) for n in probs])
    b, q = base.alias("b"), q.alias("q")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"q.{k}"))
    return b.join(q, same, "left").select("b.*", *[fix(F.col(f"q.{n}")).alias(n) for n in probs])


def _price_between(df: DataFrame, lo: float, hi: float) -> DataFrame:
    return df.filter(F.col(PRICE).between(lo, hi))


# ---- univariate -----------------------------------------------------------

def price_stats(dl: DataFrame) -> DataFrame:
    """E1."""
    d = dl.filter(F.col(PRICE).isNotNull() & (F.col(PRICE) > 0))
    return _with_quantiles(d, [], PRICE, {"median": 0.5, "p25": 0.25, "p75": 0.75, "p99": 0.99}, [
        round_half_away(F.avg(PRICE), 2).alias("mean"),
        round_half_away(F.stddev_samp(PRICE), 2).alias("std"),
        F.count(F.lit(1)).alias("n_listings"),
    ])


def price_hist(dl: DataFrame, width: float = 20.0, lo: float = 1, hi: float = 1000) -> DataFrame:
    """Fixed-width bins of the 30-day price."""
    d = _price_between(dl, lo, hi)
    b = (F.floor(F.col(PRICE) / width) * width).cast("double")
    return d.groupBy(b.alias("bin_start")).agg(F.count(F.lit(1)).alias("count")).orderBy("bin_start")


def log_price_hist(dl: DataFrame) -> DataFrame:
    """ln(price+1) in 0.1 bins."""
    d = dl.filter(F.col(PRICE) > 0)
    b = round_half_away(F.log(F.col(PRICE) + 1), 1)
    return d.groupBy(b.alias("log_bin")).agg(F.count(F.lit(1)).alias("count")).orderBy("log_bin")


def room_type_share(dl: DataFrame) -> DataFrame:
    """Count and percentage per room type (total as a scalar subquery)."""
    total = dl.agg(F.count(F.lit(1))).scalar()
    g = dl.groupBy("room_type").agg(F.count(F.lit(1)).alias("count"))
    return g.select("room_type", "count",
                    round_half_away(F.col("count") * 100.0 / total, 1).alias("pct")) \
        .orderBy(F.desc("count"), "room_type")


def top_neighbourhoods(dl: DataFrame, k: int = 20) -> DataFrame:
    """E5: the k neighbourhoods with most listings (name breaks ties)."""
    return dl.groupBy("neighbourhood").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc_nulls_last("neighbourhood")).limit(k)


def review_stats(dl: DataFrame) -> DataFrame:
    """E6."""
    return _with_quantiles(dl, [], "total_reviews", {"median": 0.5}, [
        round_half_away(F.avg("total_reviews"), 2).alias("mean"),
        round_half_away(F.count_if(F.col("total_reviews") == 0) * 100.0 / F.count(F.lit(1)), 1)
        .alias("pct_zero"),
    ], digits=None)


def review_hist(dl: DataFrame, width: int = 10, cap: int = 200) -> DataFrame:
    """Bins of 10 reviews, everything from ``cap`` up in the last bin."""
    b = capped(F.floor(F.col("total_reviews") / width) * width, cap).cast("bigint")
    return dl.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")).orderBy("bin")


def min_nights_stats(dl: DataFrame) -> DataFrame:
    """E8."""
    n = F.count(F.lit(1))
    return _with_quantiles(dl, [], "minimum_nights", {"median": 0.5}, [
        round_half_away(F.count_if(F.col("minimum_nights") == 1) * 100.0 / n, 1).alias("pct_1_night"),
        round_half_away(F.count_if(F.col("minimum_nights") >= 30) * 100.0 / n, 1).alias("pct_30plus"),
    ], digits=None)


def min_nights_hist(dl: DataFrame, cap: int = 30) -> DataFrame:
    """NULL minimum nights stays its own (NULL) bin."""
    return dl.groupBy(capped("minimum_nights", cap).alias("nights")) \
        .agg(F.count(F.lit(1)).alias("count")).orderBy("nights")


def availability_stats(dl: DataFrame) -> DataFrame:
    """E10."""
    d = dl.filter(F.col(RATE).isNotNull())
    return _with_quantiles(d, [], RATE, {"median": 0.5}, [round_half_away(F.avg(RATE), 3).alias("mean")], digits=3)


def availability_hist(dl: DataFrame) -> DataFrame:
    """E11."""
    d = dl.filter(F.col(RATE).isNotNull())
    return d.groupBy(round_half_away(RATE, 1).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("count")).orderBy("bin")


def price_quintile(dl: DataFrame) -> DataFrame:
    """Quintile label per located, priced listing.

    Edges are exact linear quantiles; bins are right-closed, the first
    includes its lower edge. Equal edges merge (the empty bin is skipped).
    """
    d = dl.filter(F.col("latitude").isNotNull() & F.col(PRICE).isNotNull())
    probs = [0.2, 0.4, 0.6, 0.8]
    edges = quantile_row(d, PRICE, probs, ["e1", "e2", "e3", "e4"]).first()  # 4 scalars
    idx = sum((F.col(PRICE) > F.lit(edges[nm])).cast("int") for nm in ["e1", "e2", "e3", "e4"])
    labels = F.array(*[F.lit(x) for x in QUINTILE_LABELS])
    return d.select("listing_id", "latitude", "longitude", F.col(PRICE).alias("price"),
                    F.element_at(labels, idx + 1).alias("price_q"))


def price_norm(dl: DataFrame, lo_p: float = 0.05, hi_p: float = 0.95) -> DataFrame:
    """Price scaled so the 5th percentile is 0 and the 95th is 1 (and clipped)."""
    d = dl.filter(F.col("latitude").isNotNull() & F.col(PRICE).isNotNull())
    q = quantile_row(d, PRICE, [lo_p, hi_p], ["q_lo", "q_hi"]).first()  # 2 scalars
    lo, hi = F.lit(q["q_lo"]), F.lit(q["q_hi"])
    norm = F.try_divide(F.col(PRICE) - lo, hi - lo)
    return d.select("listing_id", F.col(PRICE).alias("price"), norm.alias("price_norm"),
                    F.least(F.greatest(norm, F.lit(0.0)), F.lit(1.0)).alias("price_norm_clipped"))


# ---- bivariate ------------------------------------------------------------

# fixed values: names of the quartile columns
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def price_by_room_type(dl: DataFrame) -> DataFrame:
    """E14."""
    d = _price_between(dl, 1, 2000)
    return _with_quantiles(d, ["room_type"], PRICE, QUARTILES, [
        round_half_away(F.avg(PRICE), 2).alias("mean"), F.count(F.lit(1)).alias("n")]) \
        .orderBy(F.desc("median"), "room_type")


def price_by_neighbourhood(dl: DataFrame, min_n: int = 100, k: int = 20) -> DataFrame:
    """Quartiles by neighbourhood with at least ``min_n`` listings, top k by median."""
    d = _price_between(dl, 1, 2000)
    return _with_quantiles(d, ["neighbourhood"], PRICE, QUARTILES, [F.count(F.lit(1)).alias("n")]) \
        .filter(F.col("n") >= min_n).orderBy(F.desc("median"), F.asc_nulls_last("neighbourhood")).limit(k)


def corr_price_reviews(dl: DataFrame) -> DataFrame:
    """E16."""
    d = dl.filter((F.col(PRICE) > 0) & (F.col("total_reviews") >= 0))
    return d.agg(
        round_half_away(safe_corr(F.log(F.col(PRICE) + 1), F.log(F.col("total_reviews") + 1)), 4)
        .alias("r_log_log"),
        round_half_away(safe_corr(F.col(PRICE), F.col("total_reviews").cast("double")), 4).alias("r_raw"),
    )


def trend_lines(dl: DataFrame) -> DataFrame:
    """Least-squares lines over all rows (not a 10k sample)."""
    a = _price_between(dl, 1, 2000).agg(
        F.regr_slope(F.log(F.col(PRICE) + 1), F.log(F.col("total_reviews") + 1)).alias("slope"),
        F.regr_intercept(F.log(F.col(PRICE) + 1), F.log(F.col("total_reviews") + 1)).alias("intercept"),
        F.regr_count(F.log(F.col(PRICE) + 1), F.log(F.col("total_reviews") + 1)).alias("n"),
    ).withColumn("line", F.lit("log_price~log_reviews"))
    b = _price_between(dl, 1, 1000).filter(F.col(RATE).isNotNull()).agg(
        F.regr_slope(F.col(PRICE), F.col(RATE)).alias("slope"),
        F.regr_intercept(F.col(PRICE), F.col(RATE)).alias("intercept"),
        F.regr_count(F.col(PRICE), F.col(RATE)).alias("n"),
    ).withColumn("line", F.lit("price~availability"))
    return a.unionByName(b).select("line", "slope", "intercept", "n")


def corr_price_availability(dl: DataFrame) -> DataFrame:
    """E18."""
    d = dl.filter((F.col(PRICE) > 0) & F.col(RATE).isNotNull())
    return d.agg(round_half_away(safe_corr(PRICE, RATE), 4).alias("r"))


def _weekend_avgs(fa: DataFrame):
    we = F.avg(F.when(F.col("is_weekend"), F.col("price_usd")))
    wd = F.avg(F.when(~F.col("is_weekend"), F.col("price_usd")))
    return we, wd


def weekend_premium(fa: DataFrame) -> DataFrame:
    """Weekend / weekday mean price per neighbourhood and premium %."""
    d = fa.filter((F.col("price_usd") > 0) & F.col("neighbourhood").isNotNull())
    we, wd = _weekend_avgs(d)
    g = d.groupBy("neighbourhood").agg(
        round_half_away(we, 2).alias("weekend_avg"),
        round_half_away(wd, 2).alias("weekday_avg"),
        round_half_away((F.try_divide(we, nullif_zero(wd)) - 1) * 100, 2).alias("premium_pct"))
    return g.filter(F.col("weekday_avg").isNotNull() & F.col("weekend_avg").isNotNull()) \
        .orderBy(F.desc("premium_pct"), "neighbourhood")


def weekend_premium_overall(fa: DataFrame, k: int = 5) -> DataFrame:
    """City-wide mean of the neighbourhood premiums, with the top k."""
    wp = weekend_premium(fa)
    avg = wp.agg(round_half_away(F.avg("premium_pct"), 2)).scalar()
    return wp.orderBy(F.desc("premium_pct"), "neighbourhood").limit(k) \
        .select("neighbourhood", "premium_pct", avg.alias("avg_pct"))


def weekend_discounts(fa: DataFrame, k: int = 5) -> DataFrame:
    """O3: the tail of E19, the k neighbourhoods with the lowest weekend premium."""
    return weekend_premium(fa).orderBy("premium_pct", "neighbourhood").limit(k).select("neighbourhood", "premium_pct")


def monthly_reviews(fr: DataFrame, start: str = "2018-01-01") -> DataFrame:
    """E21."""
    d = fr.filter(F.col("review_date") >= F.lit(start).cast("date"))
    return d.groupBy(F.date_format("review_date", "yyyy-MM").alias("yr_mo")) \
        .agg(F.count(F.lit(1)).alias("reviews")).orderBy("yr_mo")


def peak_review_month(fr: DataFrame, start: str = "2018-01-01") -> DataFrame:
    """Month with most reviews; the earliest such month on ties."""
    return monthly_reviews(fr, start).orderBy(F.desc("reviews"), "yr_mo").limit(1)


# fixed values: result names and the columns they compare
CORR_PAIRS = [
    ("price_vs_min_nights", "current_price", "minimum_nights"),
    ("price_vs_reviews", "current_price", "total_reviews"),
    ("price_vs_avail", "current_price", RATE),
    ("min_nights_vs_reviews", "minimum_nights", "total_reviews"),
    ("min_nights_vs_avail", "minimum_nights", RATE),
    ("reviews_vs_avail", "total_reviews", RATE),
]


def corr_matrix(dl: DataFrame) -> DataFrame:
    """Six pairwise correlations in one pass, long form (pair, r)."""
    d = dl.filter((F.col("current_price") > 0) & F.col(RATE).isNotNull())
    wide = d.agg(*[round_half_away(safe_corr(F.col(x).cast("double"), F.col(y).cast("double")), 3).alias(n)
                   for n, x, y in CORR_PAIRS])
    stack = "stack({}, {}) as (pair, r)".format(
        len(CORR_PAIRS), ", ".join(f"'{n}', {n}" for n, _, _ in CORR_PAIRS))
    return wide.selectExpr(stack)


# ---- multivariate ---------------------------------------------------------

def log_features(dl: DataFrame) -> DataFrame:
    """E24."""
    d = _price_between(dl, 1, 2000).filter(F.col(RATE).isNotNull())
    return d.select("listing_id",
                    F.log(F.col(PRICE) + 1).alias("log_price"),
                    F.log(F.col("minimum_nights") + 1).alias("log_min_nights"),
                    F.log(F.col("total_reviews") + 1).alias("log_reviews"),
                    F.col(RATE).alias("avail"), "room_type")


def top_k_by_count(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values of ``col`` (value breaks ties): at most k rows."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")) \
        .orderBy(F.desc("_n"), F.asc_nulls_last(col)).limit(k).select(col)


def median_price_pivot(dl: DataFrame, k: int = 15, room_types: list[str] | None = None) -> DataFrame:
    """Median price, neighbourhood x room type, for the k largest neighbourhoods.

    The top k is counted over all listings (no price filter); the IN
    subquery is a semi join against a k-row frame.
    """
    top = top_k_by_count(dl, "neighbourhood", k)
    d = _price_between(dl, 1, 2000).join(F.broadcast(top), "neighbourhood", "left_semi")
    if room_types is None:
        from .features import levels

        room_types = levels(dl, "room_type")
    g = group_quantiles(d, ["neighbourhood", "room_type"], PRICE, {"median_price": 0.5}).select(
        "neighbourhood", "room_type", round_half_away("median_price", 0).alias("median_price"))
    return g.groupBy("neighbourhood").pivot("room_type", room_types).agg(F.first("median_price")) \
        .orderBy("neighbourhood")


def bubble_features(dl: DataFrame) -> DataFrame:
    """Price x availability, bubble size = sqrt(min(reviews, 500)) * 5."""
    d = _price_between(dl, 1, 1000).filter(F.col(RATE).isNotNull())
    return d.select("listing_id", F.col(PRICE).alias("price"), F.col(RATE).alias("avail"),
                    "total_reviews", "room_type",
                    (F.sqrt(F.least(F.col("total_reviews"), F.lit(500)).cast("double")) * 5).alias("bubble_size"))


def neighbourhood_supply(dn: DataFrame) -> DataFrame:
    """E27."""
    return dn.select(
        "neighbourhood", "avg_price_usd", "total_listings", "total_hosts",
        round_half_away(F.try_divide(F.col("total_listings"), nullif_zero(F.col("total_hosts"))), 1)
        .alias("listings_per_host"),
        round_half_away(F.col("max_price_usd") - F.col("min_price_usd"), 0).alias("price_range"),
    ).orderBy(F.desc_nulls_last("avg_price_usd"), "neighbourhood")


def price_spread_room_type(dl: DataFrame) -> DataFrame:
    """E28."""
    d = _price_between(dl, 1, 2000)
    q = _with_quantiles(d, ["room_type"], PRICE, QUARTILES | {"p10": 0.10, "p90": 0.90}, [F.count(F.lit(1)).alias("n")])
    return q.drop("n").orderBy(F.desc("median"), "room_type")


def price_spread_top20(dl: DataFrame, k: int = 20) -> DataFrame:
    """Quartiles for the k largest neighbourhoods, counted after the price filter."""
    d = _price_between(dl, 1, 2000)
    top = top_k_by_count(d, "neighbourhood", k)
    return group_quantiles(d.join(F.broadcast(top), "neighbourhood", "left_semi"), ["neighbourhood"], PRICE, QUARTILES).select(
        "neighbourhood", *[round_half_away(n, 2).alias(n) for n in QUARTILES]).orderBy(F.desc("median"), "neighbourhood")


def centroids(dl: DataFrame) -> DataFrame:
    """E30."""
    return dl.filter(F.col("latitude").isNotNull()).groupBy("neighbourhood") \
        .agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"))


def weekend_pivot(fa: DataFrame) -> DataFrame:
    """Mean price by neighbourhood x weekend, pivoted; incomplete rows dropped."""
    d = fa.filter(F.col("price_usd").between(1, 5000) & F.col("neighbourhood").isNotNull())
    g = d.groupBy("neighbourhood").agg(
        F.avg(F.when(~F.col("is_weekend"), F.col("price_usd"))).alias("weekday"),
        F.avg(F.when(F.col("is_weekend"), F.col("price_usd"))).alias("weekend"),
        F.count_if(~F.col("is_weekend")).alias("n_weekday"),
        F.count_if(F.col("is_weekend")).alias("n_weekend"),
    ).dropna(subset=["weekday", "weekend"])
    g = g.withColumn("premium_pct", (F.col("weekend") / F.col("weekday") - 1) * 100)
    avg = g.agg(round_half_away(F.avg("premium_pct"), 2)).scalar()
    return g.withColumn("avg_premium_pct", avg).orderBy(F.desc("premium_pct"), "neighbourhood")


def top_reviewed(dl: DataFrame, k: int = 10) -> DataFrame:
    """E32."""
    return dl.groupBy("neighbourhood").agg(F.sum("total_reviews").alias("total_reviews")) \
        .orderBy(F.desc("total_reviews"), F.asc_nulls_last("neighbourhood")).limit(k)


def weekend_available(fa: DataFrame) -> DataFrame:
    """E33 (flagship): weekend vs weekday mean price on available days."""
    d = fa.filter(F.col("is_available"))
    we, wd = _weekend_avgs(d)
    return d.groupBy("neighbourhood").agg(
        round_half_away(we, 2).alias("avg_weekend_price"),
        round_half_away(wd, 2).alias("avg_weekday_price"),
    ).orderBy(F.desc_nulls_last("avg_weekend_price"), F.asc_nulls_last("neighbourhood"))


def top_hosts(dh: DataFrame, k: int = 10) -> DataFrame:
    """Hosts with most listings (host_id breaks ties)."""
    return dh.select("host_id", "host_name", "total_listings", "avg_listing_price") \
        .orderBy(F.desc("total_listings"), "host_id").limit(k)
