"""Staging and mart queries (P1-P5, M1-M9, flagship E33)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import oracle, r
from ..operators import describe
from ..plans import marts, staging
from ..registry import Ctx, query
from ..sources.files import EXTRACT_COLUMNS, RAW_FILES, _share, cast_report, extract_all, hash_sample, read_csv_text, sample_rows
from ..sources.schemas import RAW_LISTINGS


@query("stg_listings")
def q_stg_listings(c: Ctx):
    return c["stg_listings"]


oracle("stg_listings", "SELECT * FROM stg_listings", ["latitude", "longitude", "price_usd"])


@query("stg_calendar")
def q_stg_calendar(c: Ctx):
    return c["stg_calendar"]


oracle("stg_calendar", "SELECT * FROM stg_calendar", ["price_usd", "adjusted_price_usd"])


@query("stg_reviews")
def q_stg_reviews(c: Ctx):
    return c["stg_reviews"]


oracle("stg_reviews", "SELECT * FROM stg_reviews")


def _boundary_summary(df, col="neighbourhood_boundary"):
    b = F.col(col)
    pts = F.flatten(F.flatten(b))
    return [
        F.size(b).alias("n_polygons"),
        F.aggregate(b, F.lit(0), lambda acc, p: acc + F.size(p)).alias("n_rings"),
        F.size(pts).alias("n_points"),
        F.array_min(F.transform(pts, lambda p: p[0])).alias("min_lon"),
        F.array_max(F.transform(pts, lambda p: p[0])).alias("max_lon"),
        F.array_min(F.transform(pts, lambda p: p[1])).alias("min_lat"),
        F.array_max(F.transform(pts, lambda p: p[1])).alias("max_lat"),
    ]


@query("stg_neighbourhoods")
def q_stg_neighbourhoods(c: Ctx):
    s = c["stg_neighbourhoods"]
    return s.select("neighbourhood", "neighbourhood_group", *_boundary_summary(s))


oracle("stg_neighbourhoods", """
SELECT neighbourhood, neighbourhood_group, CASE WHEN kind = 1 THEN 2 ELSE 1 END AS n_polygons,
       CASE WHEN kind = 0 THEN 1 ELSE 2 END AS n_rings, CASE WHEN kind = 0 THEN 5 ELSE 10 END AS n_points,
       lon0 AS min_lon, lon1 AS max_lon, lat0 AS min_lat, lat1 AS max_lat
FROM stg_neighbourhoods""", ["min_lon", "max_lon", "min_lat", "max_lat"])


@query("currency_parse")
def q_currency_parse(c: Ctx):
    """P5/P6 over the listings and calendar price text."""
    a = staging.currency_parse_report(c["raw_listings"], "price").withColumn("source", F.lit("listings"))
    b = staging.currency_parse_report(c["raw_calendar"], "price").withColumn("source", F.lit("calendar"))
    return a.unionByName(b)


oracle("currency_parse", """
SELECT count(*) AS n_rows, CAST(count(price_usd) + count_if(listing_id % 30 = 0) AS BIGINT) AS n_text, count(price_usd) AS n_parsed,
       CAST(count_if(listing_id % 30 = 0) AS BIGINT) AS n_unparsable, CAST(sum(CAST(price_usd AS DECIMAL(18, 4))) AS DOUBLE) AS sum_parsed, 'listings' AS source
FROM stg_listings
UNION ALL
SELECT count(*), count(price_usd), count(price_usd), CAST(0 AS BIGINT), CAST(sum(CAST(price_usd AS DECIMAL(18, 4))) AS DOUBLE), 'calendar'
FROM stg_calendar""", ["sum_parsed"])


@query("snapshot_window")
def q_snapshot_window(c: Ctx):
    """M1 + F1: last date, window start and the calendar rows inside the window."""
    cal = c["stg_calendar"]
    inside = marts.window_rows(cal)
    return inside.agg(F.max("date").alias("max_dt"),
                      F.date_sub(F.max("date"), 30).alias("window_start"),
                      F.count(F.lit(1)).alias("rows_in_window"),
                      F.countDistinct("date").alias("dates_in_window"))


oracle("snapshot_window", """
SELECT s.max_dt, CAST(s.max_dt - 30 AS DATE) AS window_start,
       count(*) AS rows_in_window, count(DISTINCT c.date) AS dates_in_window
FROM snapshot s JOIN stg_calendar c ON c.date BETWEEN s.max_dt - 30 AND s.max_dt
GROUP BY s.max_dt""")


@query("review_metrics")
def q_review_metrics(c: Ctx):
    return marts.review_metrics(c["stg_reviews"])


oracle("review_metrics", "SELECT * FROM review_metrics")


@query("calendar_metrics")
def q_calendar_metrics(c: Ctx):
    return marts.calendar_metrics(c["stg_calendar"])


oracle("calendar_metrics", "SELECT * FROM calendar_metrics",
       ["avg_price_next_30_days", "availability_rate_next_30_days"])


@query("dim_listings")
def q_dim_listings(c: Ctx):
    return c["dim_listings"]


oracle("dim_listings", "SELECT * FROM dim_listings",
       ["latitude", "longitude", "current_price", "avg_price_next_30_days",
        "availability_rate_next_30_days"])


@query("dim_hosts")
def q_dim_hosts(c: Ctx):
    h = c["dim_hosts"]
    return h.withColumn("neighbourhoods_hosted_in", F.array_join("neighbourhoods_hosted_in", ",")) \
            .withColumn("room_types_offered", F.array_join("room_types_offered", ","))


oracle("dim_hosts", "SELECT * FROM dim_hosts",
       ["min_listing_price", "max_listing_price", "avg_listing_price"])


@query("dim_neighbourhoods")
def q_dim_neighbourhoods(c: Ctx):
    d = c["dim_neighbourhoods"]
    summ = _boundary_summary(d)
    return d.select("neighbourhood", "neighbourhood_group", *summ, "total_listings", "total_hosts",
                    "avg_price_usd", "min_price_usd", "max_price_usd")


oracle("dim_neighbourhoods", """
SELECT neighbourhood, neighbourhood_group, CASE WHEN kind = 1 THEN 2 ELSE 1 END AS n_polygons,
       CASE WHEN kind = 0 THEN 1 ELSE 2 END AS n_rings, CASE WHEN kind = 0 THEN 5 ELSE 10 END AS n_points,
       lon0 AS min_lon, lon1 AS max_lon, lat0 AS min_lat, lat1 AS max_lat,
       total_listings, total_hosts, avg_price_usd, min_price_usd, max_price_usd
FROM dim_neighbourhoods""", ["min_lon", "max_lon", "min_lat", "max_lat", "avg_price_usd",
                             "min_price_usd", "max_price_usd"])


@query("fct_reviews")
def q_fct_reviews(c: Ctx):
    return c["fct_reviews"]


oracle("fct_reviews", "SELECT * FROM fct_reviews")


@query("fct_availability")
def q_fct_availability(c: Ctx):
    return c["fct_availability"]


oracle("fct_availability", "SELECT * FROM fct_availability", ["price_usd", "adjusted_price_usd"])


@query("weekend_available")
def q_weekend_available(c: Ctx):
    """E33, the flagship: weekend vs weekday price on available days."""
    return describe.weekend_available(c["fct_availability"])


oracle("weekend_available", """
SELECT neighbourhood,
       """ + r("avg(CASE WHEN is_weekend THEN price_usd END)", 2) + """ AS avg_weekend_price,
       """ + r("avg(CASE WHEN NOT is_weekend THEN price_usd END)", 2) + """ AS avg_weekday_price
FROM fct_availability WHERE is_available GROUP BY neighbourhood""",
       ["avg_weekend_price", "avg_weekday_price"])


@query("listings_in_boundary")
def q_listings_in_boundary(c: Ctx):
    """Neighbourhood whose boundary contains each listing (quadtree cover + ray casting at borders)."""
    from ..operators.geo import points_in_polygons

    pts = c["dim_listings"].select("listing_id", "longitude", "latitude")
    hit = points_in_polygons(pts, "longitude", "latitude", c["dim_neighbourhoods"], "listing_id")
    return hit.select("listing_id", "neighbourhood_in_boundary")


oracle("listings_in_boundary", """
SELECT l.listing_id, n.neighbourhood AS neighbourhood_in_boundary
FROM dim_listings l LEFT JOIN stg_neighbourhoods n
  ON l.longitude > n.lon0 AND l.longitude < n.lon1 AND l.latitude > n.lat0 AND l.latitude < n.lat1
     AND NOT (n.kind = 2 AND l.longitude > n.lon0 + 0.04e0 AND l.longitude < n.lon0 + 0.08e0
              AND l.latitude > n.lat0 + 0.02e0 AND l.latitude < n.lat0 + 0.04e0)""")


@query("geojson_flatten")
def q_geojson_flatten(c: Ctx):
    """Features of the landed GeoJSON files, one row each, with the kind of geometry."""
    return c["raw_neighbourhoods"].select("neighbourhood", "neighbourhood_group", F.get_json_object("geometry_json", "$.type").alias("kind"))


oracle("geojson_flatten", """
SELECT neighbourhood, neighbourhood_group, CASE WHEN kind = 1 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind FROM stg_neighbourhoods""")


@query("bronze_cast_report")
def q_bronze_cast_report(c: Ctx):
    """Texts of the raw listing columns, and those lost by their cast."""
    return cast_report(read_csv_text(c.spark, f"{c.root}/raw/{RAW_FILES['raw_listings']}"), RAW_LISTINGS)


oracle("bronze_cast_report", """
SELECT name AS "column", CAST(CASE name WHEN 'host_name' THEN h WHEN 'price' THEN p ELSE n END AS BIGINT) AS n_text, CAST(0 AS BIGINT) AS n_lost
FROM (VALUES """ + ", ".join(f"('{x.name}')" for x in RAW_LISTINGS.fields) + """) AS v(name),
     (SELECT count(*) AS n, count(host_name) AS h, count(price_usd) + count_if(listing_id % 30 = 0) AS p FROM stg_listings) AS t""")


def _extract(c: Ctx, name: str):
    """One written extract, read back; all are written once for a context."""
    return c.spark.read.parquet(c.once("extracts", lambda: extract_all(c.models, f"{c.root}/extracts"))[name])


@query("gold_extract_listings")
def q_gold_extract_listings(c: Ctx):
    """The listings extract projection."""
    return _extract(c, "dim_listings")


oracle("gold_extract_listings", """
SELECT listing_id, listing_name, host_id, host_name, neighbourhood, latitude, longitude, room_type,
       current_price, minimum_nights, total_reviews, first_review_date, last_review_date,
       avg_price_next_30_days, availability_rate_next_30_days
FROM dim_listings""", ["latitude", "longitude", "current_price", "avg_price_next_30_days",
                      "availability_rate_next_30_days"])


for _name, _table, _doubles in (("hosts", "dim_hosts", ["min_listing_price", "max_listing_price", "avg_listing_price"]),
                                ("neighbourhoods", "dim_neighbourhoods", ["avg_price_usd", "min_price_usd", "max_price_usd"]),
                                ("reviews", "fct_reviews", []), ("availability", "fct_availability", ["price_usd"])):
    query(f"gold_extract_{_name}")(lambda c, t=_table: _extract(c, t))
    oracle(f"gold_extract_{_name}", f"SELECT {', '.join(EXTRACT_COLUMNS[_table])} FROM {_table}", _doubles)


@query("listings_with_price")
def q_listings_with_price(c: Ctx):
    """Staged listings without the rows that have no price."""
    return c["stg_listings"].where("price_usd IS NOT NULL")


oracle("listings_with_price", "SELECT * FROM stg_listings WHERE price_usd IS NOT NULL", ["latitude", "longitude", "price_usd"])


@query("sample_availability")
def q_sample_availability(c: Ctx):
    """3 % row sample of the availability extract columns (a sampling operator)."""
    return sample_rows(c["fct_availability"].select(*EXTRACT_COLUMNS["fct_availability"]), 0.03, ["listing_id", "date"])


oracle("sample_availability", f"""
SELECT {", ".join(EXTRACT_COLUMNS["fct_availability"])} FROM fct_availability
WHERE md5(CAST(listing_id AS VARCHAR) || ':' || CAST(date AS VARCHAR) || ':42') < '{_share(0.03)}'""", ["price_usd"])


@query("scatter_sample")
def q_scatter_sample(c: Ctx):
    """Reproducible 5,000-listing subsample (seeded hash order) for point charts and maps."""
    dl = c["dim_listings"].where("latitude IS NOT NULL AND avg_price_next_30_days IS NOT NULL")
    return hash_sample(dl.select("listing_id", "latitude", "longitude", "room_type",
                                 "avg_price_next_30_days"), "listing_id", 5000)


oracle("scatter_sample", """
SELECT listing_id, latitude, longitude, room_type, avg_price_next_30_days FROM dim_listings
WHERE latitude IS NOT NULL AND avg_price_next_30_days IS NOT NULL
ORDER BY md5(CAST(listing_id AS VARCHAR) || ':42'), listing_id LIMIT 5000""", ["latitude", "longitude", "avg_price_next_30_days"])
