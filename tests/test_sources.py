"""File sources and sinks on hand fixtures."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics.plans.pipeline import build, target_database
from staylytics.sources import files as FS

LISTINGS = (
    'id,name,host_id,host_name,neighbourhood_cleansed,latitude,longitude,room_type,price,minimum_nights,'
    'number_of_reviews,extra_col\n'
    '1,"Flat, ""cosy""",10,Ann,Camden,51.55,-0.15,Entire home/apt,"$1,200.00",2,3,x\n'
    '2,"Room with\na line break",11,Bob,Hackney,51.54,-0.05,Private room,,1,0,y\n'
)
CALENDAR = (
    "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n"
    "1,2024-12-10,t,$100.00,,2,30\n"
    "1,2024-12-11,f,\"$1,100.00\",,2,30\n"
    "2,2024-12-11,t,not a price,,1,10\n"
)
REVIEWS = (
    "listing_id,id,date,reviewer_id,reviewer_name,comments\n"
    '1,100,2024-01-02,7,Zoe,"Great ""place""\nwould return"\n'
    "1,101,2024-02-03,8,Yan,ok\n"
)
GEOJSON = {
    "type": "FeatureCollection",
    "features": [
        {"type": "Feature", "properties": {"neighbourhood": "Camden", "neighbourhood_group": None},
         "geometry": {"type": "Polygon", "coordinates": [[[-0.2, 51.5], [-0.1, 51.5], [-0.1, 51.6],
                                                          [-0.2, 51.6], [-0.2, 51.5]]]}},
        {"type": "Feature", "properties": {"neighbourhood": "Hackney"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[
             [[-0.1, 51.5], [0.0, 51.5], [0.0, 51.6], [-0.1, 51.6], [-0.1, 51.5]],
             [[-0.06, 51.53], [-0.04, 51.53], [-0.04, 51.55], [-0.06, 51.55], [-0.06, 51.53]]]]}},
        {"type": "Feature", "properties": {"neighbourhood": "Bad", "neighbourhood_group": " "},
         "geometry": {"type": "Point", "coordinates": [0, 0]}},
    ],
}


@pytest.fixture()
def src(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for name, text in (("listings.csv.gz", LISTINGS), ("calendar.csv.gz", CALENDAR), ("reviews.csv.gz", REVIEWS)):
        with gzip.open(d / name, "wt") as f:
            f.write(text)
    (d / "neighbourhoods.geojson").write_text(json.dumps(GEOJSON, indent=1))
    return str(d)


def test_csv_multiline_and_price(spark, src):
    raw = FS.read_raw(spark, src, partitions=2)
    rows = sorted(raw["raw_listings"].collect(), key=lambda r: r["id"])
    assert len(rows) == 2
    assert rows[0]["name"] == 'Flat, "cosy"' and rows[1]["name"] == "Room with\na line break"
    m = build(raw)
    sl = {r["listing_id"]: r for r in m["stg_listings"].collect()}
    assert sl[1]["price_usd"] == 1200.0 and sl[2]["price_usd"] is None
    cal = sorted(m["stg_calendar"].collect(), key=lambda r: (r["listing_id"], r["date"]))
    assert [r["price_usd"] for r in cal] == [100.0, 1100.0, None]
    assert [r["is_available"] for r in cal] == [True, False, True]
    rv = sorted(m["stg_reviews"].collect(), key=lambda r: r["review_id"])
    assert rv[0]["comments"] == 'Great "place"\nwould return'


def test_geojson_flatten_and_groups(spark, src):
    raw = FS.read_raw(spark, src)
    nb = {r["neighbourhood"]: r for r in raw["raw_neighbourhoods"].collect()}
    assert nb["Camden"]["neighbourhood_group"] is None
    assert nb["Hackney"]["neighbourhood_group"] == ""
    m = build(raw)
    st = {r["neighbourhood"]: r for r in m["stg_neighbourhoods"].collect()}
    assert len(st["Camden"]["neighbourhood_boundary"]) == 1
    assert len(st["Hackney"]["neighbourhood_boundary"][0]) == 2   # outer ring + hole
    assert st["Bad"]["neighbourhood_boundary"] is None
    dn = {r["neighbourhood"]: r for r in m["dim_neighbourhoods"].collect()}
    assert {dn[k]["neighbourhood_group"] for k in dn} == {"London"}


def test_point_in_polygon_with_hole(spark, src):
    from staylytics.operators.geo import points_in_polygons

    m = build(FS.read_raw(spark, src))
    pts = spark.createDataFrame([(1, -0.15, 51.55), (2, -0.08, 51.52), (3, -0.05, 51.54), (4, 0.5, 51.5), (5, None, 51.5)],
                                "pid int, lon double, lat double")
    hit = {r["pid"]: r["neighbourhood_in_boundary"]
           for r in points_in_polygons(pts, "lon", "lat", m["dim_neighbourhoods"], "pid", cell=0.03).collect()}
    assert hit == {1: "Camden", 2: "Hackney", 3: None, 4: None, 5: None}   # 3 is in Hackney's hole, 4 outside, 5 nowhere


def test_ndjson_roundtrip_and_land(spark, src, tmp_path):
    raw = FS.read_raw(spark, src)
    p = str(tmp_path / "nd")
    FS.write_ndjson(raw["raw_neighbourhoods"], p)
    back = FS.read_ndjson(spark, p)
    assert back.count() == 3
    paths = FS.land_bronze(spark, src, str(tmp_path / "bronze"))
    b = FS.load_bronze(spark, str(tmp_path / "bronze"))
    assert set(paths) == set(b) and b["raw_calendar"].count() == 3


def test_marts_written_and_extract(spark, src, tmp_path):
    m = build(FS.read_raw(spark, src))
    out = str(tmp_path / "gold")
    for name in ("dim_listings", "fct_availability"):
        FS.write_mart(m[name], os.path.join(out, name), name)
    fa = spark.read.parquet(os.path.join(out, "fct_availability"))
    assert fa.count() == 3 and {"year", "month"} <= set(fa.columns)
    assert os.path.isdir(os.path.join(out, "fct_availability", "year=2024"))
    ex = str(tmp_path / "extract")
    FS.extract(m["dim_listings"], ["listing_id", "current_price"], ex)
    FS.extract(m["dim_listings"].limit(0), ["listing_id", "current_price"], ex)  # left alone
    assert spark.read.parquet(ex).count() == 2
    FS.write_stats(m["dim_listings"].groupBy().count(), str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).first()["count"] == 2


def test_layer_routing():
    assert target_database(None, "proj") == "proj"
    assert target_database("silver", "proj") == "rentals_silver"
    assert target_database("gold", "proj") == "rentals_gold"
    assert target_database(" staging ", "proj") == "proj_staging"


def test_run_pipeline(spark, src, tmp_path):
    from staylytics.plans.pipeline import run_pipeline

    paths = run_pipeline(spark, src, str(tmp_path / "wh"))
    assert set(paths) == {"dim_listings", "dim_hosts", "dim_neighbourhoods", "fct_reviews", "fct_availability"}
    assert all("rentals_gold" in p for p in paths.values())
    fa = spark.read.parquet(paths["fct_availability"])
    assert fa.count() == 3 and fa.where("listing_name IS NULL").count() == 0
    plan = fa.where("year = 2024 AND month = 12").select("price_usd")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<price_usd:double>" in plan
    dl = {r["listing_id"]: r for r in spark.read.parquet(paths["dim_listings"]).collect()}
    assert dl[1]["total_reviews"] == 2 and dl[2]["total_reviews"] == 0
    assert dl[2]["current_price"] == 0.0


def test_publish_tables(spark, src):
    from staylytics.plans.pipeline import publish_tables

    m = build(FS.read_raw(spark, src))
    names = publish_tables(spark, m)
    assert names["dim_listings"] == "rentals_gold.dim_listings"
    assert spark.table("rentals_gold.fct_availability").count() == 3
    assert spark.sql("SELECT count(*) AS n FROM stg_listings").first()["n"] == 2


def test_bucketed_tables_join_without_calendar_shuffle(spark, src):
    from staylytics.plans.pipeline import run_pipeline_tables

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        m = run_pipeline_tables(spark, src, default_db="bk", buckets=4)
        assert spark.table("rentals_gold.fct_availability").count() == 3
        plan = m.marts["fct_availability"]._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan          # both sides read as co-located buckets
        dl = {r["listing_id"]: r for r in spark.table("rentals_gold.dim_listings").collect()}
        assert dl[1]["total_reviews"] == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hash_sample_exact(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k").repartition(7)
    got = FS.hash_sample(df, "k", 300)
    plain = df.orderBy(F.md5(F.concat_ws(":", F.col("k").cast("string"), F.lit("42"))), F.col("k")).limit(300)
    assert sorted(r["k"] for r in got.collect()) == sorted(r["k"] for r in plain.collect())
    assert FS.hash_sample(df.limit(500), "k", 300).count() == 300
    assert FS.hash_sample(df.limit(10), "k", 300).count() == 10 and FS.hash_sample(df.limit(0), "k", 300).count() == 0
    some = [sorted(r["k"] for r in FS.sample_rows(df.repartition(n), 0.03, ["k"]).collect()) for n in (1, 9)]
    assert some[0] == some[1] and 450 < len(some[0]) < 750


def test_missing_column_raises_and_lost_values_are_counted(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("1", "2"), ("x", None), ("3", "4.5x")], "id string, n string")
    with pytest.raises(ValueError, match="no column n"):
        FS.conform(df.select("id"), schema)
    assert {r["column"]: (r["n_text"], r["n_lost"]) for r in FS.cast_report(df, schema).collect()} == {"id": (3, 1), "n": (2, 1)}
    assert [tuple(r) for r in FS.conform(df, schema).collect()] == [(1, 2), (None, None), (3, None)]
