"""Data-quality queries D1-D8 (registry + oracle)."""

from __future__ import annotations

from ..operators import quality as Q
from ..oracle import oracle, r
from ..registry import Ctx, query

# the oracle has tile corners instead of a boundary array; lon0 is NULL iff the boundary is
_ORACLE_COLUMN = {"neighbourhood_boundary": "lon0"}


def _oc(c: str) -> str:
    return _ORACLE_COLUMN.get(c, c)


@query("dq_checks")
def q_dq_checks(c: Ctx):
    """D1 + D2: the 20 schema tests."""
    return Q.schema_tests(c.models)


def _dq_sql() -> str:
    parts = []
    for model, col, test in Q.SCHEMA_TESTS:
        if test == "unique":
            parts.append(
                f"SELECT '{model}' AS model, '{col}' AS column_name, 'unique' AS test, count(*) AS failures "
                f"FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u")
        else:
            parts.append(
                f"SELECT '{model}', '{col}', 'not_null', CAST(count_if({_oc(col)} IS NULL) AS BIGINT) FROM {model}")
    return (", t AS (" + "\nUNION ALL\n".join(parts) + ")\n"
            "SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t")


oracle("dq_checks", _dq_sql())


def _audit_sql(tables: dict[str, list[str]]) -> str:
    parts = []
    for t, cols in tables.items():
        for col in cols:
            nn = f"CAST(count_if({_oc(col)} IS NULL) AS BIGINT)"
            pct = f"(CASE WHEN count(*) > 0 THEN {nn} * 100.0e0 / count(*) ELSE 0.0e0 END)"
            parts.append(
                f"SELECT '{t}' AS table_name, '{col}' AS column_name, count(*) AS total_rows, {nn} AS null_count, "
                f"{r(pct, 2)} AS null_pct, CASE WHEN {nn} = 0 THEN 'OK' WHEN {pct} < 50 THEN 'PARTIAL' "
                f"ELSE 'MAJOR' END AS status FROM {t}")
    return "\nUNION ALL\n".join(parts)


@query("null_audit")
def q_null_audit(c: Ctx):
    """D3 over the five gold tables, whole tables (no sampling)."""
    return Q.gold_null_audit(c.models)


oracle("null_audit", _audit_sql(Q.GOLD_COLUMNS), ["null_pct"])


@query("null_audit_issues")
def q_null_audit_issues(c: Ctx):
    """D4."""
    return Q.null_audit_issues(Q.gold_null_audit(c.models))


oracle("null_audit_issues", f", a AS ({_audit_sql(Q.GOLD_COLUMNS)})\nSELECT * FROM a WHERE null_count > 0",
       ["null_pct"])

# raw column -> the staging column the oracle reads it from (every raw value parses)
RAW_TO_STG = {
    "raw_listings": ("stg_listings", {
        "id": "listing_id", "name": "listing_name", "host_id": "host_id", "host_name": "host_name",
        "neighbourhood_cleansed": "neighbourhood", "latitude": "latitude", "longitude": "longitude",
        "room_type": "room_type", "price": "price_usd", "minimum_nights": "minimum_nights",
        "number_of_reviews": "number_of_reviews"}),
    "raw_calendar": ("stg_calendar", {
        "listing_id": "listing_id", "date": "date", "available": "is_available", "price": "price_usd",
        "adjusted_price": "adjusted_price_usd", "minimum_nights": "minimum_nights",
        "maximum_nights": "maximum_nights"}),
}


@query("null_profile_raw")
def q_null_profile_raw(c: Ctx):
    """D5 + D6 on the bronze listings and calendar."""
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName, [Q.null_profile(c[t], t) for t in RAW_TO_STG])


def _null_profile_sql() -> str:
    parts = []
    for raw, (stg, cols) in RAW_TO_STG.items():
        for rc, sc in cols.items():
            # a listing price that does not parse is text in the raw table
            text = " AND listing_id % 30 <> 0" if (raw, rc) == ("raw_listings", "price") else ""
            parts.append(f"SELECT '{raw}' AS table_name, '{rc}' AS column_name, "
                         f"count_if({sc} IS NULL{text}) AS n, count(*) AS total FROM {stg}")
    return (", p AS (" + "\nUNION ALL\n".join(parts) + ")\n"
            "SELECT table_name, column_name, n * 100.0e0 / total AS null_pct, n = total AS all_null "
            "FROM p WHERE n > 0")


oracle("null_profile_raw", _null_profile_sql(), ["null_pct"])


@query("raw_profile")
def q_raw_profile(c: Ctx):
    """Shape and date range of the raw tables."""
    return Q.raw_profile(c.bronze)


oracle("raw_profile", """
SELECT 'raw_listings' AS table_name, count(*) AS n_rows, 11 AS n_columns,
       CAST(NULL AS DATE) AS min_date, CAST(NULL AS DATE) AS max_date FROM stg_listings
UNION ALL SELECT 'raw_calendar', count(*), 7, min(date), max(date) FROM stg_calendar
UNION ALL SELECT 'raw_reviews', count(*), 6, min(date), max(date) FROM stg_reviews""")


@query("available_counts")
def q_available_counts(c: Ctx):
    """Value counts of the raw availability flag."""
    return Q.category_counts(c["raw_calendar"], "available")


oracle("available_counts", """
SELECT CASE WHEN is_available THEN 't' ELSE 'f' END AS available, count(*) AS count
FROM stg_calendar GROUP BY 1""")


@query("rows_per_listing")
def q_rows_per_listing(c: Ctx):
    """D8 for all listings."""
    return Q.rows_per_listing(c["stg_listings"], c["stg_calendar"], c["stg_reviews"])


oracle("rows_per_listing", """
SELECT l.listing_id, COALESCE(c.n, 0) AS calendar_rows, COALESCE(v.n, 0) AS review_rows
FROM stg_listings l
LEFT JOIN (SELECT listing_id, count(*) AS n FROM stg_calendar GROUP BY 1) c ON c.listing_id = l.listing_id
LEFT JOIN (SELECT listing_id, count(*) AS n FROM stg_reviews GROUP BY 1) v ON v.listing_id = l.listing_id""")
