"""Key checks and null audit on a hand fixture with planted failures."""

from staylytics.operators import quality as Q
from staylytics.plans.pipeline import build
from staylytics.sources import schemas as S


def bronze(spark):
    listings = spark.createDataFrame([
        (1, "a", 10, "H1", "N1", 51.5, -0.1, "Entire home/apt", "$10.00", 1, 0),
        (1, "dup", 10, "H1", "N1", 51.5, -0.1, "Private room", "$12.00", 1, 0),
        (None, "noid", 11, "H2", "N2", None, None, "Private room", None, 2, 0),
    ], S.RAW_LISTINGS)
    import datetime as dt
    cal = spark.createDataFrame([(1, dt.date(2024, 1, 1), "t", "$10.00", None, 1, 5),
                                 (None, dt.date(2024, 1, 1), "f", "$10.00", None, 1, 5)], S.RAW_CALENDAR)
    rev = spark.createDataFrame([(1, 100, dt.date(2023, 5, 1), 7, "r", "ok"),
                                 (1, 100, dt.date(2023, 5, 2), 8, "s", "ok")], S.RAW_REVIEWS)
    nb = spark.createDataFrame([("N1", None, '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'),
                                ("N2", "G", "not json")], S.RAW_NEIGHBOURHOODS)
    return {"raw_listings": listings, "raw_calendar": cal, "raw_reviews": rev, "raw_neighbourhoods": nb}


def test_schema_tests_find_planted_failures(spark):
    m = build(bronze(spark))
    res = {(r["model"], r["column_name"], r["test"]): (r["failures"], r["status"])
           for r in Q.schema_tests(m).collect()}
    assert len(res) == 20
    assert res[("stg_listings", "listing_id", "unique")] == (1, "FAIL")
    assert res[("stg_listings", "listing_id", "not_null")] == (1, "FAIL")
    assert res[("stg_calendar", "listing_id", "not_null")] == (1, "FAIL")
    assert res[("stg_reviews", "review_id", "unique")] == (1, "FAIL")
    assert res[("stg_neighbourhoods", "neighbourhood_boundary", "not_null")] == (1, "FAIL")
    assert res[("stg_neighbourhoods", "neighbourhood", "unique")] == (0, "PASS")


def test_null_audit_status(spark):
    m = build(bronze(spark))
    a = {r["column_name"]: r for r in Q.null_audit(m["dim_listings"], "dim_listings").collect()}
    assert a["listing_name"]["status"] == "OK"
    assert a["latitude"]["null_count"] == 1 and a["latitude"]["status"] == "PARTIAL"
    assert a["first_review_date"]["status"] in ("PARTIAL", "MAJOR")
    issues = Q.null_audit_issues(Q.null_audit(m["dim_listings"], "dim_listings"))
    assert issues.where("null_count = 0").count() == 0
