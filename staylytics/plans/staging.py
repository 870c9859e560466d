"""Silver layer: rename, cast and parse the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import currency_to_double
from ..sources.schemas import MULTIPOLYGON, POLYGON


def stg_listings(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("listing_id"),
        F.col("name").alias("listing_name"),
        "host_id",
        "host_name",
        F.col("neighbourhood_cleansed").alias("neighbourhood"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "room_type",
        currency_to_double("price").alias("price_usd"),
        F.col("minimum_nights").cast("int").alias("minimum_nights"),
        F.col("number_of_reviews").cast("bigint").alias("number_of_reviews"),
    )


def stg_calendar(raw: DataFrame) -> DataFrame:
    return raw.select(
        "listing_id",
        F.col("date").cast("date").alias("date"),
        F.col("available").try_cast("boolean").alias("is_available"),
        currency_to_double("price").alias("price_usd"),
        currency_to_double("adjusted_price").alias("adjusted_price_usd"),
        F.col("minimum_nights").cast("int").alias("minimum_nights"),
        F.col("maximum_nights").cast("int").alias("maximum_nights"),
    )


def stg_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "listing_id",
        F.col("id").alias("review_id"),
        F.col("date").cast("date").alias("date"),
        "reviewer_id",
        "reviewer_name",
        "comments",
    )


def geometry_to_multipolygon(geometry_json) -> F.Column:
    """GeoJSON Polygon / MultiPolygon text -> MultiPolygon coordinate array.

    A Polygon becomes a one-element MultiPolygon; anything else, or text
    that does not parse, becomes NULL (reported by the not_null check).
    """
    g = F.col(geometry_json) if isinstance(geometry_json, str) else geometry_json
    gtype = F.get_json_object(g, "$.type")
    coords = F.get_json_object(g, "$.coordinates")
    return (F.when(gtype == "Polygon", F.array(F.from_json(coords, POLYGON)))
            .when(gtype == "MultiPolygon", F.from_json(coords, MULTIPOLYGON)))


def stg_neighbourhoods(raw: DataFrame) -> DataFrame:
    return raw.select(
        "neighbourhood",
        "neighbourhood_group",
        geometry_to_multipolygon("geometry_json").alias("neighbourhood_boundary"),
    )


def currency_parse_report(raw: DataFrame, column: str = "price") -> DataFrame:
    """P5/P6 audit: rows with price text, parsed, dropped, and text that failed to parse."""
    parsed = currency_to_double(column)
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.col(column)).alias("n_text"),
        F.count(parsed).alias("n_parsed"),
        F.count_if(F.col(column).isNotNull() & parsed.isNull()).alias("n_unparsable"),
        F.sum(parsed.cast("decimal(18,4)")).cast("double").alias("sum_parsed"),  # exact, whatever the order
    )
