"""Descriptive queries E1-E34 (registry + oracle)."""

from __future__ import annotations

from ..operators import describe as E
from ..oracle import oracle, r
from ..registry import Ctx, query

P = "avg_price_next_30_days"
RATE = "availability_rate_next_30_days"
# Test-data parameters (the reference's values suit a 95k-listing city; FIXTURES.md §2)
MIN_N_NEIGHBOURHOOD = 20
REVIEWS_SINCE = "1998-01-01"
# fixed values: room types present in the test tables (c_mktsegment), the pivot's columns
TEST_ROOM_TYPES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def qd(x: str, p: float) -> str:
    return f"quantile_disc({x}, {p})"


def dl(c: Ctx):
    return c["dim_listings"]


@query("price_stats")
def q_price_stats(c): return E.price_stats(dl(c))


oracle("price_stats", f"""
SELECT {r(f'avg({P})', 2)} AS mean, {r(qd(P, 0.5), 2)} AS median, {r(f'stddev_samp({P})', 2)} AS std,
       {r(qd(P, 0.25), 2)} AS p25, {r(qd(P, 0.75), 2)} AS p75, {r(qd(P, 0.99), 2)} AS p99,
       count(*) AS n_listings
FROM dim_listings WHERE {P} IS NOT NULL AND {P} > 0""", ["mean", "median", "std", "p25", "p75", "p99"])


@query("price_hist")
def q_price_hist(c): return E.price_hist(dl(c))


oracle("price_hist", f"""
SELECT CAST(floor({P} / 20) * 20 AS DOUBLE) AS bin_start, count(*) AS count
FROM dim_listings WHERE {P} BETWEEN 1 AND 1000 GROUP BY 1""", ["bin_start"])


@query("log_price_hist")
def q_log_price_hist(c): return E.log_price_hist(dl(c))


oracle("log_price_hist", f"""
SELECT {r(f'ln({P} + 1)', 1)} AS log_bin, count(*) AS count
FROM dim_listings WHERE {P} > 0 GROUP BY 1""", ["log_bin"])


@query("room_type_share")
def q_room_type_share(c): return E.room_type_share(dl(c))


oracle("room_type_share", f"""
SELECT room_type, count(*) AS count, {r('count(*) * 100.0e0 / sum(count(*)) OVER ()', 1)} AS pct
FROM dim_listings GROUP BY room_type""", ["pct"])


@query("top_neighbourhoods")
def q_top_neighbourhoods(c): return E.top_neighbourhoods(dl(c))


oracle("top_neighbourhoods", """
SELECT neighbourhood, count(*) AS count FROM dim_listings GROUP BY 1
ORDER BY count DESC, neighbourhood ASC NULLS LAST LIMIT 20""")


@query("review_stats")
def q_review_stats(c): return E.review_stats(dl(c))


oracle("review_stats", f"""
SELECT {r('avg(total_reviews)', 2)} AS mean, {qd('total_reviews', 0.5)} AS median,
       {r('count_if(total_reviews = 0) * 100.0e0 / count(*)', 1)} AS pct_zero
FROM dim_listings""", ["mean", "pct_zero"])


@query("review_hist")
def q_review_hist(c): return E.review_hist(dl(c))


oracle("review_hist", """
SELECT CAST(least(floor(total_reviews / 10) * 10, 200) AS BIGINT) AS bin, count(*) AS count
FROM dim_listings GROUP BY 1""")


@query("min_nights_stats")
def q_min_nights_stats(c): return E.min_nights_stats(dl(c))


oracle("min_nights_stats", f"""
SELECT {qd('minimum_nights', 0.5)} AS median,
       {r('count_if(minimum_nights = 1) * 100.0e0 / count(*)', 1)} AS pct_1_night,
       {r('count_if(minimum_nights >= 30) * 100.0e0 / count(*)', 1)} AS pct_30plus
FROM dim_listings""", ["pct_1_night", "pct_30plus"])


@query("min_nights_hist")
def q_min_nights_hist(c): return E.min_nights_hist(dl(c))


oracle("min_nights_hist", """
SELECT CASE WHEN minimum_nights IS NOT NULL THEN least(minimum_nights, 30) END AS nights, count(*) AS count
FROM dim_listings GROUP BY 1""")


@query("availability_stats")
def q_availability_stats(c): return E.availability_stats(dl(c))


oracle("availability_stats", f"""
SELECT {r(f'avg({RATE})', 3)} AS mean, {r(qd(RATE, 0.5), 3)} AS median
FROM dim_listings WHERE {RATE} IS NOT NULL""", ["mean", "median"])


@query("availability_hist")
def q_availability_hist(c): return E.availability_hist(dl(c))


oracle("availability_hist", f"""
SELECT {r(RATE, 1)} AS bin, count(*) AS count
FROM dim_listings WHERE {RATE} IS NOT NULL GROUP BY 1""", ["bin"])


@query("price_quintile")
def q_price_quintile(c): return E.price_quintile(dl(c))


oracle("price_quintile", f"""
, d AS (SELECT * FROM dim_listings WHERE latitude IS NOT NULL AND {P} IS NOT NULL),
e AS (SELECT quantile_cont({P}, 0.2) AS e1, quantile_cont({P}, 0.4) AS e2,
             quantile_cont({P}, 0.6) AS e3, quantile_cont({P}, 0.8) AS e4 FROM d)
SELECT listing_id, latitude, longitude, {P} AS price,
       list_extract(['Q1 cheapest', 'Q2', 'Q3', 'Q4', 'Q5 priciest'],
                    1 + CAST({P} > e1 AS INTEGER) + CAST({P} > e2 AS INTEGER)
                      + CAST({P} > e3 AS INTEGER) + CAST({P} > e4 AS INTEGER)) AS price_q
FROM d, e""", ["latitude", "longitude", "price"])


@query("price_norm")
def q_price_norm(c): return E.price_norm(dl(c))


oracle("price_norm", f"""
, d AS (SELECT * FROM dim_listings WHERE latitude IS NOT NULL AND {P} IS NOT NULL),
q AS (SELECT quantile_cont({P}, 0.05) AS lo, quantile_cont({P}, 0.95) AS hi FROM d)
SELECT listing_id, {P} AS price,
       CASE WHEN hi = lo THEN NULL ELSE ({P} - lo) / (hi - lo) END AS price_norm,
       least(greatest(CASE WHEN hi = lo THEN NULL ELSE ({P} - lo) / (hi - lo) END, 0.0e0), 1.0e0)
         AS price_norm_clipped
FROM d, q""", ["price", "price_norm", "price_norm_clipped"])


def quartiles_sql(x: str = P) -> str:
    return f"{r(qd(x, 0.25), 2)} AS p25, {r(qd(x, 0.5), 2)} AS median, {r(qd(x, 0.75), 2)} AS p75"


@query("price_by_room_type")
def q_price_by_room_type(c): return E.price_by_room_type(dl(c))


oracle("price_by_room_type", f"""
SELECT room_type, {quartiles_sql()}, {r(f'avg({P})', 2)} AS mean, count(*) AS n
FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 GROUP BY room_type""",
       ["p25", "median", "p75", "mean"])


@query("price_by_neighbourhood")
def q_price_by_neighbourhood(c): return E.price_by_neighbourhood(dl(c), min_n=MIN_N_NEIGHBOURHOOD)


oracle("price_by_neighbourhood", f"""
SELECT neighbourhood, {quartiles_sql()}, count(*) AS n
FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 GROUP BY neighbourhood
HAVING count(*) >= {MIN_N_NEIGHBOURHOOD}
ORDER BY median DESC, neighbourhood ASC NULLS LAST LIMIT 20""", ["p25", "median", "p75"])


@query("corr_price_reviews")
def q_corr_price_reviews(c): return E.corr_price_reviews(dl(c))


oracle("corr_price_reviews", f"""
SELECT {r(f'corr(ln({P} + 1), ln(total_reviews + 1))', 4)} AS r_log_log,
       {r(f'corr({P}, total_reviews)', 4)} AS r_raw
FROM dim_listings WHERE {P} > 0 AND total_reviews >= 0""", ["r_log_log", "r_raw"])


@query("trend_lines")
def q_trend_lines(c): return E.trend_lines(dl(c))


oracle("trend_lines", f"""
SELECT 'log_price~log_reviews' AS line,
       regr_slope(ln({P} + 1), ln(total_reviews + 1)) AS slope,
       regr_intercept(ln({P} + 1), ln(total_reviews + 1)) AS intercept,
       CAST(regr_count(ln({P} + 1), ln(total_reviews + 1)) AS BIGINT) AS n
FROM dim_listings WHERE {P} BETWEEN 1 AND 2000
UNION ALL
SELECT 'price~availability', regr_slope({P}, {RATE}), regr_intercept({P}, {RATE}),
       CAST(regr_count({P}, {RATE}) AS BIGINT)
FROM dim_listings WHERE {P} BETWEEN 1 AND 1000 AND {RATE} IS NOT NULL""", ["slope", "intercept"])


@query("corr_price_availability")
def q_corr_price_availability(c): return E.corr_price_availability(dl(c))


oracle("corr_price_availability", f"""
SELECT {r(f'corr({P}, {RATE})', 4)} AS r
FROM dim_listings WHERE {P} > 0 AND {RATE} IS NOT NULL""", ["r"])


WEEKEND_SQL = """
, wp0 AS (
  SELECT neighbourhood, avg(CASE WHEN is_weekend THEN price_usd END) AS we,
         avg(CASE WHEN NOT is_weekend THEN price_usd END) AS wd
  FROM fct_availability WHERE price_usd > 0 AND neighbourhood IS NOT NULL GROUP BY 1),
wp AS (
  SELECT neighbourhood, """ + r("we", 2) + """ AS weekend_avg, """ + r("wd", 2) + """ AS weekday_avg,
         """ + r("(we / NULLIF(wd, 0) - 1) * 100", 2) + """ AS premium_pct
  FROM wp0 WHERE we IS NOT NULL AND wd IS NOT NULL)
"""


@query("weekend_premium")
def q_weekend_premium(c): return E.weekend_premium(c["fct_availability"])


oracle("weekend_premium", WEEKEND_SQL + "SELECT * FROM wp", ["weekend_avg", "weekday_avg", "premium_pct"])


@query("weekend_premium_overall")
def q_weekend_premium_overall(c): return E.weekend_premium_overall(c["fct_availability"])


oracle("weekend_premium_overall", WEEKEND_SQL + f"""
SELECT neighbourhood, premium_pct, (SELECT {r('avg(premium_pct)', 2)} FROM wp) AS avg_pct
FROM wp ORDER BY premium_pct DESC, neighbourhood LIMIT 5""", ["premium_pct", "avg_pct"])


@query("weekend_discounts")
def q_weekend_discounts(c): return E.weekend_discounts(c["fct_availability"])


oracle("weekend_discounts", WEEKEND_SQL + """
SELECT neighbourhood, premium_pct FROM wp ORDER BY premium_pct, neighbourhood LIMIT 5""", ["premium_pct"])


@query("monthly_reviews")
def q_monthly_reviews(c): return E.monthly_reviews(c["fct_reviews"], REVIEWS_SINCE)


oracle("monthly_reviews", f"""
SELECT strftime(review_date, '%Y-%m') AS yr_mo, count(*) AS reviews
FROM fct_reviews WHERE review_date >= DATE '{REVIEWS_SINCE}' GROUP BY 1""")


@query("peak_review_month")
def q_peak_review_month(c): return E.peak_review_month(c["fct_reviews"], REVIEWS_SINCE)


oracle("peak_review_month", f"""
SELECT strftime(review_date, '%Y-%m') AS yr_mo, count(*) AS reviews
FROM fct_reviews WHERE review_date >= DATE '{REVIEWS_SINCE}' GROUP BY 1
ORDER BY reviews DESC, yr_mo LIMIT 1""")


@query("corr_matrix")
def q_corr_matrix(c): return E.corr_matrix(dl(c))


oracle("corr_matrix", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS pair, {r(f'corr({x}, {y})', 3)} AS r FROM dim_listings "
    f"WHERE current_price > 0 AND {RATE} IS NOT NULL"
    for n, x, y in E.CORR_PAIRS), ["r"])


@query("log_features")
def q_log_features(c): return E.log_features(dl(c))


oracle("log_features", f"""
SELECT listing_id, ln({P} + 1) AS log_price, ln(minimum_nights + 1) AS log_min_nights,
       ln(total_reviews + 1) AS log_reviews, {RATE} AS avail, room_type
FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 AND {RATE} IS NOT NULL""",
       ["log_price", "log_min_nights", "log_reviews", "avail"])


@query("median_price_pivot")
def q_median_price_pivot(c): return E.median_price_pivot(dl(c))


oracle("median_price_pivot", f"""
, top AS (SELECT neighbourhood FROM dim_listings GROUP BY 1
          ORDER BY count(*) DESC, neighbourhood ASC NULLS LAST LIMIT 15),
g AS (SELECT neighbourhood, room_type, {r(qd(P, 0.5), 0)} AS median_price
      FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 AND neighbourhood IN (SELECT neighbourhood FROM top)
      GROUP BY 1, 2)
SELECT neighbourhood, """ + ", ".join(
    f"max(CASE WHEN room_type = '{t}' THEN median_price END) AS \"{t}\"" for t in TEST_ROOM_TYPES) + """
FROM g GROUP BY neighbourhood""", TEST_ROOM_TYPES)


@query("bubble_features")
def q_bubble_features(c): return E.bubble_features(dl(c))


oracle("bubble_features", f"""
SELECT listing_id, {P} AS price, {RATE} AS avail, total_reviews, room_type,
       sqrt(least(total_reviews, 500)) * 5 AS bubble_size
FROM dim_listings WHERE {P} BETWEEN 1 AND 1000 AND {RATE} IS NOT NULL""",
       ["price", "avail", "bubble_size"])


@query("neighbourhood_supply")
def q_neighbourhood_supply(c): return E.neighbourhood_supply(c["dim_neighbourhoods"])


oracle("neighbourhood_supply", f"""
SELECT neighbourhood, avg_price_usd, total_listings, total_hosts,
       {r('total_listings / NULLIF(total_hosts, 0)', 1)} AS listings_per_host,
       {r('max_price_usd - min_price_usd', 0)} AS price_range
FROM dim_neighbourhoods""", ["avg_price_usd", "listings_per_host", "price_range"])


@query("price_spread_room_type")
def q_price_spread_room_type(c): return E.price_spread_room_type(dl(c))


oracle("price_spread_room_type", f"""
SELECT room_type, {quartiles_sql()}, {r(qd(P, 0.1), 2)} AS p10, {r(qd(P, 0.9), 2)} AS p90
FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 GROUP BY room_type""",
       ["p25", "median", "p75", "p10", "p90"])


@query("price_spread_top20")
def q_price_spread_top20(c): return E.price_spread_top20(dl(c))


oracle("price_spread_top20", f"""
, d AS (SELECT * FROM dim_listings WHERE {P} BETWEEN 1 AND 2000),
top AS (SELECT neighbourhood FROM d GROUP BY 1 ORDER BY count(*) DESC, neighbourhood ASC NULLS LAST LIMIT 20)
SELECT neighbourhood, {quartiles_sql()}
FROM d WHERE neighbourhood IN (SELECT neighbourhood FROM top) GROUP BY neighbourhood""",
       ["p25", "median", "p75"])


@query("centroids")
def q_centroids(c): return E.centroids(dl(c))


oracle("centroids", """
SELECT neighbourhood, avg(latitude) AS lat, avg(longitude) AS lon
FROM dim_listings WHERE latitude IS NOT NULL GROUP BY 1""", ["lat", "lon"])


@query("weekend_pivot")
def q_weekend_pivot(c): return E.weekend_pivot(c["fct_availability"])


oracle("weekend_pivot", f"""
, g AS (
  SELECT neighbourhood,
         avg(CASE WHEN NOT is_weekend THEN price_usd END) AS weekday,
         avg(CASE WHEN is_weekend THEN price_usd END) AS weekend,
         CAST(count_if(NOT is_weekend) AS BIGINT) AS n_weekday, CAST(count_if(is_weekend) AS BIGINT) AS n_weekend
  FROM fct_availability WHERE price_usd BETWEEN 1 AND 5000 AND neighbourhood IS NOT NULL
  GROUP BY 1),
h AS (SELECT *, (weekend / weekday - 1) * 100 AS premium_pct FROM g
      WHERE weekday IS NOT NULL AND weekend IS NOT NULL)
SELECT *, (SELECT {r('avg(premium_pct)', 2)} FROM h) AS avg_premium_pct FROM h""",
       ["weekday", "weekend", "premium_pct", "avg_premium_pct"])


@query("top_reviewed")
def q_top_reviewed(c): return E.top_reviewed(dl(c))


oracle("top_reviewed", """
SELECT neighbourhood, CAST(sum(total_reviews) AS BIGINT) AS total_reviews FROM dim_listings
GROUP BY 1 ORDER BY total_reviews DESC, neighbourhood ASC NULLS LAST LIMIT 10""")


@query("top_hosts")
def q_top_hosts(c): return E.top_hosts(c["dim_hosts"])


oracle("top_hosts", """
SELECT host_id, host_name, total_listings, avg_listing_price FROM dim_hosts
ORDER BY total_listings DESC, host_id LIMIT 10""", ["avg_listing_price"])
