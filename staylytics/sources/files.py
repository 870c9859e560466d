"""Raw files -> bronze tables (S1-S4), and the writers of the pipeline.

Real snapshot files carry many more columns than the models read, so
CSVs are read with every column as text (no inference pass over the
data) and the needed columns are picked by header name and cast with
``try_cast``. A raw file may be a file, a folder of files or a glob. A gzip file cannot be split: it arrives as one partition
and is repartitioned right after the read so later stages run wide; a
folder with files for most cores is read as it lies.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import date_parts
from . import schemas as S

RAW_FILES = {
    "raw_listings": "listings.csv.gz",
    "raw_calendar": "calendar.csv.gz",
    "raw_reviews": "reviews.csv.gz",
    "raw_neighbourhoods": "neighbourhoods.geojson",
}


#: Of the bronze and gold tables; their texts and dates repeat, and take about a third less than as snappy.
COMPRESSION = "zstd"


def _partitions(spark: SparkSession, n: int | None) -> int:
    return n or int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV (gzip or plain), quoted fields with line breaks and doubled quotes."""
    return (spark.read.option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .csv(path))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the schema's columns by name and cast them; text that does not parse becomes NULL (see ``cast_report``)."""
    _check_columns(df, schema)
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _check_columns(df: DataFrame, schema: T.StructType) -> None:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source has no column {', '.join(missing)}; it has {', '.join(df.columns)}")


def cast_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, n_text, n_lost): texts of each column, and those that ``conform`` turns into NULL."""
    _check_columns(df, schema)
    names = [f.name for f in schema.fields]
    row = df.agg(*[F.count(F.col(f"`{n}`")).alias(f"t{i}") for i, n in enumerate(names)],
                 *[F.count(F.col(f"`{f.name}`").try_cast(f.dataType)).alias(f"c{i}") for i, f in enumerate(schema.fields)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"t{i}").alias("n_text"), (
        F.col(f"t{i}") - F.col(f"c{i}")).alias("n_lost")) for i, n in enumerate(names)])))


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None) -> DataFrame:
    df = conform(read_csv_text(spark, path), schema)
    if not partitions and 2 * df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1:
        return df  # wide already: no shuffle of every row
    return df.repartition(_partitions(spark, partitions))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection -> (neighbourhood, neighbourhood_group, geometry_json).

    ``geometry`` is declared as a string, so Spark keeps the raw JSON
    text of the object. A property key that is absent becomes '' (an
    explicit null stays NULL), as the reference's flattening does.
    """
    fc = spark.read.schema(S.GEOJSON_FEATURES).option("multiLine", True).json(path)
    feats = fc.select(F.inline("features"))

    def prop(k: str):
        return F.when(F.map_contains_key("properties", k), F.col("properties")[k]).otherwise(F.lit(""))

    return feats.select(prop("neighbourhood").alias("neighbourhood"),
                        prop("neighbourhood_group").alias("neighbourhood_group"),
                        F.col("geometry").alias("geometry_json"))


def write_ndjson(df: DataFrame, path: str) -> None:
    """S3: newline-delimited JSON."""
    df.write.mode("overwrite").json(path)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType = S.RAW_NEIGHBOURHOODS) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_raw(spark: SparkSession, src_dir: str, partitions: int | None = None) -> dict[str, DataFrame]:
    """The four raw files of one snapshot as bronze DataFrames."""
    return {
        "raw_listings": read_raw_csv(spark, os.path.join(src_dir, RAW_FILES["raw_listings"]), S.RAW_LISTINGS,
                                     partitions),
        "raw_calendar": read_raw_csv(spark, os.path.join(src_dir, RAW_FILES["raw_calendar"]), S.RAW_CALENDAR,
                                     partitions),
        "raw_reviews": read_raw_csv(spark, os.path.join(src_dir, RAW_FILES["raw_reviews"]), S.RAW_REVIEWS,
                                    partitions),
        "raw_neighbourhoods": read_geojson(spark, os.path.join(src_dir, RAW_FILES["raw_neighbourhoods"])),
    }


def land_bronze(spark: SparkSession, src_dir: str, out_dir: str, partitions: int | None = None) -> dict[str, str]:
    """Raw files -> Parquet bronze tables under ``out_dir``; returns name -> path."""
    paths = {}
    for name, df in read_raw(spark, src_dir, partitions).items():
        p = os.path.join(out_dir, name)
        if name == "raw_calendar":  # by date, so that a window of dates skips files and row groups
            df = df.repartitionByRange(_partitions(spark, partitions), "date").sortWithinPartitions("date")
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(p)
        paths[name] = p
    return paths


def load_bronze(spark: SparkSession, bronze_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(os.path.join(bronze_dir, name)) for name in RAW_FILES}


def by_month(df: DataFrame) -> DataFrame:
    """The availability fact with the rows of a month together, by one shuffle, after which AQE splits each
    month's partition into advisory-size tasks and merges small ones. What follows from the date
    (``columns.date_parts``) is not shuffled but derived again after it."""
    parts = {name: part for name, part in date_parts("date").items() if name in df.columns}
    rows = df.drop(*parts).withColumn("_month", F.trunc("date", "month")).hint("rebalance", "_month")
    return rows.select(*[parts[c].alias(c) if c in parts else F.col(c) for c in df.columns])


def write_mart(df: DataFrame, path: str, name: str) -> None:
    """Full overwrite of one mart. The availability fact is partitioned by
    year and month (date-window filters then prune files) and sorted by
    listing within each file."""
    if name == "fct_availability":
        # REBALANCE on (year, month): a task writes mostly one month
        # and files are neither tiny nor huge at any scale. (Hashing on (year, month) without AQE would leave ~13 tasks for a snapshot;
        # a range repartition would compute the whole fact twice.)
        by_month(df).sortWithinPartitions("year", "month", "listing_id", "date") \
            .write.mode("overwrite").option("compression", COMPRESSION).partitionBy("year", "month").parquet(path)
    else:
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


# fixed values: the column set of each table's columnar extract
EXTRACT_COLUMNS = {
    "dim_listings": ["listing_id", "listing_name", "host_id", "host_name", "neighbourhood", "latitude",
                     "longitude", "room_type", "current_price", "minimum_nights", "total_reviews",
                     "first_review_date", "last_review_date", "avg_price_next_30_days",
                     "availability_rate_next_30_days"],
    "dim_hosts": ["host_id", "host_name", "total_listings", "min_listing_price", "max_listing_price",
                  "avg_listing_price", "total_reviews_across_listings"],
    "dim_neighbourhoods": ["neighbourhood", "neighbourhood_group", "total_listings", "total_hosts",
                           "avg_price_usd", "min_price_usd", "max_price_usd"],
    "fct_reviews": ["review_id", "listing_id", "review_date", "reviewer_id", "reviewer_name", "comments",
                    "listing_name", "neighbourhood", "room_type", "host_id", "host_name"],
    "fct_availability": ["listing_id", "date", "is_available", "price_usd", "minimum_nights",
                         "maximum_nights", "neighbourhood", "room_type", "year", "month", "month_name",
                         "day_of_week", "is_weekend"],
}


def _draw(keys: list[str], seed: int):
    """A uniform hexadecimal text for each row: MD5 of its key columns and the seed."""
    return F.md5(F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))


def _share(fraction: float) -> str:
    """The text below which ``fraction`` of all draws lie."""
    return format(min(int(fraction * 2 ** 60), 2 ** 60 - 1), "015x") if fraction < 1 else "g"


def sample_rows(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """Each row stays with probability ``fraction``; its key decides, whatever the partitions."""
    return df.where(_draw(keys, seed) < F.lit(_share(fraction)))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A reproducible subsample of n rows without replacement.

    The n rows with the lowest draws (key as tie-break). Draws are
    uniform, so rows below 2n/N are about 2n; if they are n at least, the
    n lowest are among them and only these are sorted.
    """
    drawn = df.select("*", _draw([key], seed).alias("_h"))
    kept = drawn.where(F.col("_h") < F.lit(_share(2.0 * n / max(1, drawn.count()))))
    return (kept if kept.count() >= n else drawn).orderBy("_h", key).limit(n).drop("_h")


def extract_all(models, out_dir: str, availability_fraction: float | None = None) -> dict[str, str]:
    """Write every extract; the availability extract may be a row sample."""
    paths = {}
    for name, cols in EXTRACT_COLUMNS.items():
        df = models[name]
        if name == "fct_availability" and availability_fraction:
            df = sample_rows(df, availability_fraction, ["listing_id", "date"])
        paths[name] = os.path.join(out_dir, f"{name}.parquet")
        extract(df, cols, paths[name])
    return paths


def extract(df: DataFrame, cols: list[str], path: str) -> None:
    """Columnar extract of a projection; left alone if it already exists."""
    df.select(*cols).write.mode("ignore").parquet(path)


def write_stats(df: DataFrame, path: str) -> None:
    """Persist a result frame as JSON lines."""
    df.write.mode("overwrite").json(path)
