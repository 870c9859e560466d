"""DuckDB SQL that computes the same results as the registered Spark queries.

The driver registers the test tables (region, nation, customer, orders,
lineitem, ...) as views. ``BASE`` rebuilds the staging and gold tables
from them with the FIXTURES.md §2 mapping; each oracle query is
``WITH <BASE> <query>``. Doubles are rounded half away from zero in
binary floating point on both sides (``r(x, d)``), so engines agree bit
for bit; every double output column is rounded to 6 digits at the end.
"""

from __future__ import annotations


def r(expr: str, d: int) -> str:
    """Same rounding as functions.columns.round_half_away."""
    return (f"(CASE WHEN abs({expr}) * 1e{d} >= 9007199254740992e0 THEN {expr} "
            f"ELSE sign({expr}) * floor(abs({expr}) * 1e{d} + 0.5) / 1e{d} END)")


BASE = """
stg_reviews AS (
  SELECT o_custkey AS listing_id, o_orderkey AS review_id, CAST(o_orderdate AS DATE) AS date,
         o_orderkey % 5000 AS reviewer_id, o_orderpriority AS reviewer_name,
         'order ' || o_orderstatus AS comments
  FROM orders
),
hosts_and_guests AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal FROM customer
  UNION ALL
  SELECT s_suppkey + 1099511627776, s_name, s_nationkey,
         ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][s_suppkey % 5 + 1], s_acctbal FROM supplier
),
stg_listings AS (
  SELECT c.c_custkey AS listing_id, c.c_name AS listing_name,
         CAST(floor(c.c_custkey * 3 / 5) AS BIGINT) AS host_id,
         CASE WHEN CAST(floor(c.c_custkey * 3 / 5) AS BIGINT) % 97 = 0 THEN NULL
              ELSE 'Host ' || CAST(CAST(floor(c.c_custkey * 3 / 5) AS BIGINT) AS VARCHAR) END AS host_name,
         n.n_name AS neighbourhood,
         51.3e0 + (c.c_custkey % 400) / 1000.0e0 + 0.0005e0 AS latitude,
         -0.5e0 + (c.c_custkey % 800) / 1000.0e0 + 0.0005e0 AS longitude,
         c.c_mktsegment AS room_type,
         CASE WHEN c.c_custkey % 3 = 0 THEN NULL
              ELSE CAST(CAST((c.c_acctbal + 1000) / 20 AS DECIMAL(14,4)) AS DOUBLE) END AS price_usd,
         CAST(c.c_custkey % 45 + 1 AS INTEGER) AS minimum_nights,
         CAST(COALESCE(rv.n_rev, 0) AS BIGINT) AS number_of_reviews
  FROM hosts_and_guests c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT listing_id, count(*) AS n_rev FROM stg_reviews GROUP BY listing_id) rv
         ON rv.listing_id = c.c_custkey
),
stg_calendar AS (
  SELECT o.o_custkey AS listing_id, CAST(l.l_shipdate AS DATE) AS date,
         COALESCE(l.l_returnflag <> 'R', false) AS is_available,
         CAST(CAST(l.l_extendedprice / 100 AS DECIMAL(14,4)) AS DOUBLE) AS price_usd,
         CASE WHEN l.l_linenumber = 7 AND l.l_quantity = 50
              THEN CAST(CAST(l.l_extendedprice / 100 AS DECIMAL(14,4)) AS DOUBLE) END AS adjusted_price_usd,
         CAST(l.l_linenumber AS INTEGER) AS minimum_nights,
         CAST(l.l_quantity AS INTEGER) AS maximum_nights
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
stg_neighbourhoods AS (
  SELECT n.n_name AS neighbourhood,
         CASE WHEN n.n_regionkey = 0 THEN NULL ELSE r.r_name END AS neighbourhood_group,
         CAST(n.n_nationkey % 3 AS INTEGER) AS kind,
         -0.5e0 + 0.16e0 * (n.n_nationkey % 5) AS lon0,
         51.3e0 + 0.08e0 * floor(n.n_nationkey / 5) AS lat0,
         -0.5e0 + 0.16e0 * (n.n_nationkey % 5) + 0.16e0 AS lon1,
         51.3e0 + 0.08e0 * floor(n.n_nationkey / 5) + 0.08e0 AS lat1
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
snapshot AS (SELECT max(date) AS max_dt FROM stg_calendar),
review_metrics AS (
  SELECT listing_id, count(review_id) AS total_reviews,
         min(date) AS first_review_date, max(date) AS last_review_date
  FROM stg_reviews GROUP BY listing_id
),
calendar_metrics AS (
  SELECT c.listing_id, avg(c.price_usd) AS avg_price_next_30_days,
         count_if(c.is_available) / count(c.date) AS availability_rate_next_30_days
  FROM stg_calendar c, snapshot s
  WHERE c.date BETWEEN s.max_dt - 30 AND s.max_dt
  GROUP BY c.listing_id
),
dim_listings AS (
  SELECT l.listing_id, l.listing_name, l.host_id, l.host_name, l.neighbourhood, l.latitude,
         l.longitude, l.room_type, COALESCE(l.price_usd, 0.0) AS current_price, l.minimum_nights,
         CAST(COALESCE(rm.total_reviews, 0) AS BIGINT) AS total_reviews,
         rm.first_review_date, rm.last_review_date,
         cm.avg_price_next_30_days, cm.availability_rate_next_30_days
  FROM stg_listings l
  LEFT JOIN review_metrics rm ON l.listing_id = rm.listing_id
  LEFT JOIN calendar_metrics cm ON l.listing_id = cm.listing_id
),
dim_hosts AS (
  SELECT host_id, host_name, count(listing_id) AS total_listings,
         COALESCE(array_to_string(list_sort(list(DISTINCT neighbourhood) FILTER (WHERE neighbourhood IS NOT NULL)), ','), '') AS neighbourhoods_hosted_in,
         COALESCE(array_to_string(list_sort(list(DISTINCT room_type) FILTER (WHERE room_type IS NOT NULL)), ','), '') AS room_types_offered,
         min(price_usd) AS min_listing_price, max(price_usd) AS max_listing_price,
         """ + r("avg(price_usd)", 2) + """ AS avg_listing_price,
         CAST(sum(number_of_reviews) AS BIGINT) AS total_reviews_across_listings
  FROM stg_listings GROUP BY host_id, host_name
),
listing_stats AS (
  SELECT neighbourhood, count(listing_id) AS total_listings, count(DISTINCT host_id) AS total_hosts,
         """ + r("avg(price_usd)", 2) + """ AS avg_price_usd,
         min(price_usd) AS min_price_usd, max(price_usd) AS max_price_usd
  FROM stg_listings GROUP BY neighbourhood
),
dim_neighbourhoods AS (
  SELECT n.neighbourhood, COALESCE(NULLIF(trim(n.neighbourhood_group), ''), 'London') AS neighbourhood_group,
         n.kind, n.lon0, n.lat0, n.lon1, n.lat1,
         COALESCE(ls.total_listings, 0) AS total_listings, COALESCE(ls.total_hosts, 0) AS total_hosts,
         ls.avg_price_usd, ls.min_price_usd, ls.max_price_usd
  FROM stg_neighbourhoods n LEFT JOIN listing_stats ls ON n.neighbourhood = ls.neighbourhood
),
fct_reviews AS (
  SELECT r.review_id, r.listing_id, r.date AS review_date, r.reviewer_id, r.reviewer_name, r.comments,
         l.listing_name, l.neighbourhood, l.room_type, l.host_id, l.host_name
  FROM stg_reviews r LEFT JOIN dim_listings l ON r.listing_id = l.listing_id
),
fct_availability AS (
  SELECT c.listing_id, c.date, c.is_available, c.price_usd, c.adjusted_price_usd,
         c.minimum_nights, c.maximum_nights,
         l.listing_name, l.host_id, l.host_name, l.neighbourhood, l.room_type,
         CAST(year(c.date) AS INTEGER) AS year, CAST(month(c.date) AS INTEGER) AS month,
         strftime(c.date, '%B') AS month_name,
         CAST(dayofweek(c.date) + 1 AS INTEGER) AS day_of_week,
         COALESCE(dayofweek(c.date) + 1 IN (1, 7), false) AS is_weekend
  FROM stg_calendar c LEFT JOIN dim_listings l ON c.listing_id = l.listing_id
)
"""

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, doubles: tuple[str, ...] | list[str] = ()) -> None:
    """Register ``WITH BASE body``; round the listed double columns to 6 digits."""
    sql = f"WITH {BASE.strip()}\n{body.strip()}"
    if doubles:
        repl = ", ".join(f"{r(c, 6)} AS {c}" for c in doubles)
        sql = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) q"
    ORACLE[name] = sql
