"""Gold layer: dimensions and facts (M1-M9).

Every aggregate is computed before its join (review and calendar metrics
per listing, listing stats per neighbourhood), so the joins see one row
per key on the build side. Join strategy is left to AQE: it turns a
sort-merge join into a broadcast hash join only when the runtime size of
the build side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
and splits skewed partitions of the large (probe) side otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_parts, round_half_away


def snapshot_max_date(calendar: DataFrame) -> DataFrame:
    """M1: one row, the last date of the snapshot."""
    return calendar.agg(F.max("date").alias("max_dt"))


def review_metrics(reviews: DataFrame) -> DataFrame:
    """M2: review count and first / last review date per listing."""
    return reviews.groupBy("listing_id").agg(
        F.count("review_id").alias("total_reviews"),
        F.min("date").alias("first_review_date"),
        F.max("date").alias("last_review_date"),
    )


def window_rows(calendar: DataFrame, days: int = 30) -> DataFrame:
    """calendar rows of the last ``days``+1 dates of the snapshot.

    No date is after the snapshot's last one, so the window is a lower
    bound only. It is computed inside a scalar subquery: the scan then
    gets ``date >= <value>`` as a pushed-down filter.
    """
    first = calendar.agg(F.date_sub(F.max("date"), days)).scalar()
    return calendar.filter(F.col("date") >= first)


def calendar_metrics(calendar: DataFrame, days: int = 30) -> DataFrame:
    """M3: mean price and availability rate over the last ``days``+1 dates."""
    return window_rows(calendar, days).groupBy("listing_id").agg(
        F.avg("price_usd").alias("avg_price_next_30_days"),
        (F.count_if(F.col("is_available")) / F.count("date")).alias("availability_rate_next_30_days"),
    )


def dim_listings(listings: DataFrame, reviews: DataFrame, calendar: DataFrame, days: int = 30) -> DataFrame:
    """M4: listings with review and calendar metrics (two LEFT joins on listing_id)."""
    rm = review_metrics(reviews)
    cm = calendar_metrics(calendar, days)
    l = listings.alias("l")
    return (
        l.join(rm.alias("rm"), F.col("l.listing_id") == F.col("rm.listing_id"), "left")
        .join(cm.alias("cm"), F.col("l.listing_id") == F.col("cm.listing_id"), "left")
        .select(
            F.col("l.listing_id"), "l.listing_name", "l.host_id", "l.host_name", "l.neighbourhood",
            "l.latitude", "l.longitude", "l.room_type",
            F.coalesce(F.col("l.price_usd"), F.lit(0.0)).alias("current_price"),
            "l.minimum_nights",
            F.coalesce(F.col("rm.total_reviews"), F.lit(0)).alias("total_reviews"),
            "rm.first_review_date", "rm.last_review_date",
            "cm.avg_price_next_30_days", "cm.availability_rate_next_30_days",
        )
    )


def dim_hosts(listings: DataFrame) -> DataFrame:
    """M5: one row per (host_id, host_name); arrays sorted, NULL dropped.

    collect_set is partially aggregated map-side, so a host with a huge
    number of listings still moves at most one small set per task.
    """
    return listings.groupBy("host_id", "host_name").agg(
        F.count("listing_id").alias("total_listings"),
        F.sort_array(F.collect_set("neighbourhood")).alias("neighbourhoods_hosted_in"),
        F.sort_array(F.collect_set("room_type")).alias("room_types_offered"),
        F.min("price_usd").alias("min_listing_price"),
        F.max("price_usd").alias("max_listing_price"),
        round_half_away(F.avg("price_usd"), 2).alias("avg_listing_price"),
        F.sum("number_of_reviews").alias("total_reviews_across_listings"),
    )


def listing_stats(listings: DataFrame) -> DataFrame:
    """M6: per neighbourhood counts and price range (exact COUNT DISTINCT hosts)."""
    return listings.groupBy("neighbourhood").agg(
        F.count("listing_id").alias("total_listings"),
        F.countDistinct("host_id").alias("total_hosts"),
        round_half_away(F.avg("price_usd"), 2).alias("avg_price_usd"),
        F.min("price_usd").alias("min_price_usd"),
        F.max("price_usd").alias("max_price_usd"),
    )


def dim_neighbourhoods(neighbourhoods: DataFrame, listings: DataFrame,
                       default_group: str = "London") -> DataFrame:
    """M7: boundaries with listing stats; a missing or blank group gets ``default_group``."""
    ls = listing_stats(listings).alias("ls")
    n = neighbourhoods.alias("n")
    return n.join(ls, F.col("n.neighbourhood") == F.col("ls.neighbourhood"), "left").select(
        F.col("n.neighbourhood"),
        F.coalesce(F.nullif(F.trim(F.col("n.neighbourhood_group")), F.lit("")), F.lit(default_group))
        .alias("neighbourhood_group"),
        "n.neighbourhood_boundary",
        F.coalesce(F.col("ls.total_listings"), F.lit(0)).alias("total_listings"),
        F.coalesce(F.col("ls.total_hosts"), F.lit(0)).alias("total_hosts"),
        "ls.avg_price_usd", "ls.min_price_usd", "ls.max_price_usd",
    )


def fct_reviews(reviews: DataFrame, dim_l: DataFrame) -> DataFrame:
    """M8: every review, with listing context (LEFT join keeps unknown listings)."""
    r = reviews.alias("r")
    l = dim_l.select("listing_id", "listing_name", "neighbourhood", "room_type",
                     "host_id", "host_name").alias("l")
    return r.join(l, F.col("r.listing_id") == F.col("l.listing_id"), "left").select(
        "r.review_id", F.col("r.listing_id"), F.col("r.date").alias("review_date"),
        "r.reviewer_id", "r.reviewer_name", "r.comments",
        "l.listing_name", "l.neighbourhood", "l.room_type", "l.host_id", "l.host_name",
    )


def fct_availability(calendar: DataFrame, dim_l: DataFrame) -> DataFrame:
    """M9: daily calendar with listing context, date parts and weekend flag.

    The build side is pruned to six columns before the join; the calendar
    (the largest table) is the streamed side.
    """
    c = calendar.alias("c")
    l = dim_l.select("listing_id", "listing_name", "host_id", "host_name",
                     "neighbourhood", "room_type").alias("l")
    d = F.col("c.date")
    return c.join(l, F.col("c.listing_id") == F.col("l.listing_id"), "left").select(
        F.col("c.listing_id"), d.alias("date"), "c.is_available", "c.price_usd",
        "c.adjusted_price_usd", "c.minimum_nights", "c.maximum_nights",
        "l.listing_name", "l.host_id", "l.host_name", "l.neighbourhood", "l.room_type",
        *[part.alias(name) for name, part in date_parts(d).items()],
    )
