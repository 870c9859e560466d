"""Data quality: key checks (D1, D2), null audit (D3-D6), raw profile.

Each table is scanned once per kind of check: all not-null counts of a
table in one aggregate, each unique check as one partially aggregated
groupBy on its key. Results are small long-form DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_away

# fixed values: the reference's 20 schema tests, (model, column, test)
SCHEMA_TESTS = [
    ("stg_listings", "listing_id", "unique"),
    ("stg_listings", "listing_id", "not_null"),
    ("stg_calendar", "listing_id", "not_null"),
    ("stg_reviews", "review_id", "unique"),
    ("stg_reviews", "review_id", "not_null"),
    ("stg_reviews", "listing_id", "not_null"),
    ("stg_neighbourhoods", "neighbourhood", "unique"),
    ("stg_neighbourhoods", "neighbourhood", "not_null"),
    ("stg_neighbourhoods", "neighbourhood_boundary", "not_null"),
    ("dim_listings", "listing_id", "unique"),
    ("dim_listings", "listing_id", "not_null"),
    ("dim_hosts", "host_id", "unique"),
    ("dim_hosts", "host_id", "not_null"),
    ("dim_neighbourhoods", "neighbourhood", "unique"),
    ("dim_neighbourhoods", "neighbourhood", "not_null"),
    ("dim_neighbourhoods", "neighbourhood_boundary", "not_null"),
    ("fct_reviews", "review_id", "unique"),
    ("fct_reviews", "review_id", "not_null"),
    ("fct_reviews", "listing_id", "not_null"),
    ("fct_availability", "listing_id", "not_null"),
]

# fixed values: columns audited per gold table
GOLD_COLUMNS = {
    "dim_listings": [
        "listing_id", "listing_name", "host_id", "host_name", "neighbourhood", "latitude",
        "longitude", "room_type", "current_price", "minimum_nights", "total_reviews",
        "first_review_date", "last_review_date", "avg_price_next_30_days",
        "availability_rate_next_30_days",
    ],
    "dim_hosts": [
        "host_id", "host_name", "total_listings", "neighbourhoods_hosted_in", "room_types_offered",
        "min_listing_price", "max_listing_price", "avg_listing_price", "total_reviews_across_listings",
    ],
    "dim_neighbourhoods": [
        "neighbourhood", "neighbourhood_group", "neighbourhood_boundary", "total_listings",
        "total_hosts", "avg_price_usd", "min_price_usd", "max_price_usd",
    ],
    "fct_reviews": [
        "review_id", "listing_id", "review_date", "reviewer_id", "reviewer_name", "comments",
        "listing_name", "neighbourhood", "room_type", "host_id", "host_name",
    ],
    "fct_availability": [
        "listing_id", "date", "is_available", "price_usd", "adjusted_price_usd", "minimum_nights",
        "maximum_nights", "listing_name", "host_id", "host_name", "neighbourhood", "room_type",
        "year", "month", "month_name", "day_of_week", "is_weekend",
    ],
}


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-null key values that occur more than once, with their counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_occurrences")).filter(F.col("n_occurrences") > 1))


def schema_tests(models, tests=SCHEMA_TESTS) -> DataFrame:
    """Run the key checks; one row per test with its failure count and PASS/FAIL.

    One scan per model: with a unique test the rows are grouped by that key
    (partially aggregated map-side) and the NULL counts of the not_null
    columns ride along as per-key sums; without one, a single aggregate.
    """
    by_model: dict[str, dict] = {}
    for model, column, test in tests:
        spec = by_model.setdefault(model, {"unique": [], "not_null": []})
        spec[test].append(column)
    parts = []
    for model, spec in by_model.items():
        df = models[model]
        nn = spec["not_null"]
        if len(spec["unique"]) == 1:
            key = spec["unique"][0]
            g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(nn)])
            agg = g.agg(F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("u0"),
                        *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(nn))])
            uniq = [(key, "u0")]
        else:
            agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(nn)])
            uniq = []
            for key in spec["unique"]:
                n = unique_failures(df, key).agg(F.count(F.lit(1)).alias("failures"))
                parts.append(n.select(F.lit(model).alias("model"), F.lit(key).alias("column_name"),
                                      F.lit("unique").alias("test"), "failures"))
        rows = [(c, f"u{j}", "unique") for j, (c, _) in enumerate(uniq)] + \
               [(c, f"n{i}", "not_null") for i, c in enumerate(nn)]
        if not rows:
            continue
        stack = "stack({}, {}) as (column_name, test, failures)".format(
            len(rows), ", ".join(f"'{c}', '{t}', CAST({a} AS BIGINT)" for c, a, t in rows))
        parts.append(agg.selectExpr(f"'{model}' as model", stack)
                     .select("model", "column_name", "test", "failures"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def null_audit(df: DataFrame, table: str, columns: list[str] | None = None,
               fraction: float | None = None, seed: int = 42) -> DataFrame:
    """D3: total rows, NULL count, NULL % and status per column, in one pass.

    ``fraction`` optionally audits a row sample; by default the whole table.
    """
    cols = columns or df.columns
    src = df.sample(fraction=fraction, seed=seed) if fraction else df
    agg = src.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = "stack({}, {}) as (column_name, null_count)".format(
        len(cols), ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols)))
    long = agg.selectExpr("total_rows", stack)
    pct = F.when(F.col("total_rows") > 0, F.col("null_count") * 100.0 / F.col("total_rows")).otherwise(0.0)
    return long.select(
        F.lit(table).alias("table_name"), "column_name", "total_rows", "null_count",
        round_half_away(pct, 2).alias("null_pct"),
        F.when(F.col("null_count") == 0, "OK").when(pct < 50, "PARTIAL").otherwise("MAJOR").alias("status"),
    )


def gold_null_audit(models, tables=GOLD_COLUMNS, fraction: dict[str, float] | None = None) -> DataFrame:
    parts = [null_audit(models[t], t, cols, (fraction or {}).get(t)) for t, cols in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_audit_issues(audit: DataFrame) -> DataFrame:
    """Columns with at least one NULL, over all audited tables."""
    return audit.filter(F.col("null_count") > 0)


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """NULL % per column where > 0, with an all-NULL flag."""
    a = null_audit(df, table)
    raw_pct = F.col("null_count") * 100.0 / F.col("total_rows")
    return a.filter(F.col("null_count") > 0).select(
        "table_name", "column_name", raw_pct.alias("null_pct"),
        (F.col("null_count") == F.col("total_rows")).alias("all_null"))


def raw_profile(bronze: dict[str, DataFrame]) -> DataFrame:
    """Shape and date range per raw table."""
    parts = []
    for name in ("raw_listings", "raw_calendar", "raw_reviews"):
        df = bronze[name]
        has_date = "date" in df.columns
        parts.append(df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            (F.min("date") if has_date else F.lit(None).cast("date")).alias("min_date"),
            (F.max("date") if has_date else F.lit(None).cast("date")).alias("max_date"),
        ))
    return reduce(DataFrame.unionByName, parts)


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Value counts, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def rows_per_listing(listings: DataFrame, calendar: DataFrame, reviews: DataFrame) -> DataFrame:
    """D8 for every listing at once: its calendar and review row counts."""
    cal = calendar.groupBy("listing_id").agg(F.count(F.lit(1)).alias("calendar_rows"))
    rev = reviews.groupBy("listing_id").agg(F.count(F.lit(1)).alias("review_rows"))
    return (listings.select("listing_id").join(cal, "listing_id", "left").join(rev, "listing_id", "left")
            .select("listing_id", F.coalesce("calendar_rows", F.lit(0)).alias("calendar_rows"),
                    F.coalesce("review_rows", F.lit(0)).alias("review_rows")))
