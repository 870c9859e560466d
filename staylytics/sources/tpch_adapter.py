"""Bronze tables derived from the driver's TPC-H-style test tables.

The mapping is fixed by FIXTURES.md §2 so that Spark and the DuckDB
oracle build the same raw inputs. Prices are emitted as '$' text and
availability as 't'/'f' so staging really parses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import RAW_FILES

TPCH_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")
#: Suppliers are listings too (without reviews or calendar); their ids start here.
SUPPLIER_BASE = 1 << 40
# fixed values: the customer segments of the test tables, used as room types
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def load_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TPCH_TABLES}


def _money_text(x) -> F.Column:
    return F.concat(F.lit("$"), x.cast("decimal(14,4)").cast("string"))


def raw_reviews(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    return o.select(
        F.col("o_custkey").alias("listing_id"),
        F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("date"),
        (F.col("o_orderkey") % 5000).alias("reviewer_id"),
        F.col("o_orderpriority").alias("reviewer_name"),
        F.concat(F.lit("order "), F.col("o_orderstatus")).alias("comments"),
    )


def raw_listings(t: dict[str, DataFrame]) -> DataFrame:
    n = t["nation"]
    segments = F.array(*map(F.lit, SEGMENTS))
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal").unionByName(t["supplier"].select(
        (F.col("s_suppkey") + F.lit(SUPPLIER_BASE)).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.element_at(segments, (F.col("s_suppkey") % len(SEGMENTS) + 1).cast("int")).alias("c_mktsegment"),
        F.col("s_acctbal").alias("c_acctbal")))
    key = F.col("c_custkey")
    host_id = F.floor(key * 3 / 5).cast("bigint")
    n_reviews = raw_reviews(t).groupBy("listing_id").agg(F.count(F.lit(1)).alias("n_rev"))
    base = c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        host_id.alias("host_id"),
        F.when(host_id % 97 != 0, F.concat(F.lit("Host "), host_id.cast("string"))).alias("host_name"),
        F.col("n_name").alias("neighbourhood_cleansed"),
        (F.lit(51.3) + (key % 400) / F.lit(1000.0) + F.lit(0.0005)).alias("latitude"),
        (F.lit(-0.5) + (key % 800) / F.lit(1000.0) + F.lit(0.0005)).alias("longitude"),
        F.col("c_mktsegment").alias("room_type"),
        F.when(key % 3 != 0, _money_text((F.col("c_acctbal") + 1000) / 20)).when(key % 30 == 0, "on request").alias("price"),
        (key % 45 + 1).cast("int").alias("minimum_nights"),
    )
    return (base.join(n_reviews, base.id == n_reviews.listing_id, "left")
            .select(*[F.col(x) for x in base.columns if x != "number_of_reviews"],
                    F.coalesce(F.col("n_rev"), F.lit(0)).alias("number_of_reviews")))


def raw_calendar(t: dict[str, DataFrame]) -> DataFrame:
    # flag and date in their short form before the join, which shuffles every row
    li = t["lineitem"].select("l_orderkey", "l_extendedprice", "l_linenumber", "l_quantity", F.to_date("l_shipdate").alias("date"),
                              F.coalesce(F.col("l_returnflag") != "R", F.lit(False)).alias("is_available"))
    o = t["orders"]
    j = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey, "inner")
    price = F.col("l_extendedprice") / 100
    return j.select(
        F.col("o_custkey").alias("listing_id"),
        "date",
        F.when(F.col("is_available"), F.lit("t")).otherwise(F.lit("f")).alias("available"),
        _money_text(price).alias("price"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") == 50), _money_text(price))
        .alias("adjusted_price"),
        F.col("l_linenumber").cast("int").alias("minimum_nights"),
        F.col("l_quantity").cast("int").alias("maximum_nights"),
    )


def raw_neighbourhoods(t: dict[str, DataFrame]) -> DataFrame:
    """One square tile per nation, as GeoJSON text.

    By nation key modulo 3 it is a Polygon, a MultiPolygon of the tile's
    two halves, or a Polygon with a hole.
    """
    n, r = t["nation"], t["region"]
    k = F.col("n_nationkey")
    lon0 = F.lit(-0.5) + F.lit(0.16) * (k % 5)
    lat0 = F.lit(51.3) + F.lit(0.08) * F.floor(k / 5)
    lon1, lat1 = lon0 + F.lit(0.16), lat0 + F.lit(0.08)

    def ring(x0, y0, x1, y1):
        return F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))

    def geometry(kind: str, coordinates):
        return F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))

    mid = lon0 + F.lit(0.08)
    whole = ring(lon0, lat0, lon1, lat1)
    hole = ring(lon0 + F.lit(0.04), lat0 + F.lit(0.02), mid, lat0 + F.lit(0.04))
    geom = (F.when(k % 3 == 1, geometry("MultiPolygon", F.array(F.array(ring(lon0, lat0, mid, lat1)), F.array(ring(mid, lat0, lon1, lat1)))))
            .when(k % 3 == 2, geometry("Polygon", F.array(whole, hole))).otherwise(geometry("Polygon", F.array(whole))))
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_name").alias("neighbourhood"),
        F.when(F.col("n_regionkey") != 0, F.col("r_name")).alias("neighbourhood_group"),
        geom.alias("geometry_json"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = load_tpch(spark, sf_dir)
    return {
        "raw_listings": raw_listings(t),
        "raw_calendar": raw_calendar(t),
        "raw_reviews": raw_reviews(t),
        "raw_neighbourhoods": raw_neighbourhoods(t),
    }


#: GeoJSON files that the boundaries are dealt into.
GEOJSON_FILES = 4


def write_raw_files(spark: SparkSession, sf_dir: str, out_dir: str) -> None:
    """The four raw tables as the files a snapshot comes in: folders of gzip CSV, and of GeoJSON."""
    for name, df in raw_tables(spark, sf_dir).items():
        path = f"{out_dir}/{RAW_FILES[name]}"
        if name != "raw_neighbourhoods":
            df.write.option("header", True).option("quote", '"').option("escape", '"').option("compression", "gzip").csv(path)
            continue
        props = F.to_json(F.struct("neighbourhood", "neighbourhood_group"), {"ignoreNullFields": "false"})
        feature = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.col("geometry_json"), F.lit("}"))
        one = df.groupBy(F.pmod(F.xxhash64("neighbourhood"), F.lit(GEOJSON_FILES)).alias("file")).agg(F.concat(
            F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list(feature)), F.lit("]}")).alias("value"))
        one.write.partitionBy("file").text(path)
