"""Rows are moved no more often, and no wider, than the layout of the written tables needs."""

import os

from pyspark.sql import functions as F

from staylytics.sources import files as FS
from staylytics.sources import schemas as S


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_folder_of_many_files_is_read_as_it_lies(spark, tmp_path):
    cols = ["listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments"]
    rows = spark.range(4000).select(*[F.md5(F.concat_ws(":", F.lit(c), "id")).alias(c) for c in cols])
    many, one = str(tmp_path / "many"), str(tmp_path / "one")
    rows.repartition(8).write.option("header", True).option("compression", "gzip").csv(many)
    rows.coalesce(1).write.option("header", True).option("compression", "gzip").csv(one)
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        as_lies, dealt = (FS.read_raw_csv(spark, p, S.RAW_REVIEWS) for p in (many, one))
        assert "Exchange" not in plan_of(as_lies) and "Exchange" in plan_of(dealt)
        assert as_lies.count() == dealt.count() == 4000
        assert as_lies.exceptAll(dealt).count() == 0
        assert "Exchange" in plan_of(FS.read_raw_csv(spark, many, S.RAW_REVIEWS, partitions=3))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_what_follows_from_the_date_is_not_shuffled(spark, tmp_path):
    from staylytics.plans import marts

    cal = spark.createDataFrame(
        [(i % 5 if i % 7 else None, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}" if i % 11 else None, i % 2 == 0, float(i), None, 1, 9) for i in range(200)] * 2,
        "listing_id long, date string, is_available boolean, price_usd double, adjusted_price_usd double, minimum_nights int, maximum_nights int"
    ).withColumn("date", F.col("date").cast("date"))
    dim = spark.createDataFrame([(i, f"n{i}", i, None, "x", "y") for i in range(4)],
                                "listing_id long, listing_name string, host_id long, host_name string, neighbourhood string, room_type string")
    fact = marts.fct_availability(cal, dim)
    moved = FS.by_month(fact)
    assert moved.schema == fact.schema
    assert moved.exceptAll(fact).count() == 0 and fact.exceptAll(moved).count() == 0
    plan = plan_of(moved)
    above, below = plan.split("REBALANCE_PARTITIONS", 1)
    assert "MMMM" in above and "MMMM" not in below and "dayofweek" not in below
    path = os.path.join(str(tmp_path), "fact")
    FS.write_mart(fact, path, "fct_availability")
    back = spark.read.parquet(path).select(*fact.columns)
    assert back.exceptAll(fact).count() == 0 and fact.exceptAll(back).count() == 0
