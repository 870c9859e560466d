"""Source registry (S5), layer routing (S8) and the model build in dependency order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import marts, staging

# layer -> database name (the routing rule: silver and gold have fixed names)
LAYER_DATABASES = {"silver": "rentals_silver", "gold": "rentals_gold"}

STAGING_MODELS = ("stg_listings", "stg_calendar", "stg_reviews", "stg_neighbourhoods")
MART_MODELS = ("dim_listings", "dim_hosts", "dim_neighbourhoods", "fct_reviews", "fct_availability")


def target_database(custom: str | None, default: str) -> str:
    """No custom layer -> default; silver/gold -> mapped; other -> '<default>_<trimmed>'."""
    if custom is None:
        return default
    if custom in LAYER_DATABASES:
        return LAYER_DATABASES[custom]
    return f"{default}_{custom.strip()}"


@dataclass
class Models:
    staging: dict[str, DataFrame] = field(default_factory=dict)
    marts: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.marts.get(name) if name in self.marts else self.staging[name]


def build(bronze: dict[str, DataFrame], days: int = 30, default_group: str = "London",
          dim_listings_override: DataFrame | None = None) -> Models:
    """Staging then marts, as lazy DataFrames; Spark plans the rest.

    ``dim_listings_override`` lets a caller pass a materialised
    ``dim_listings`` (written table or checkpoint) that both facts reuse.
    """
    m = Models()
    m.staging["stg_listings"] = staging.stg_listings(bronze["raw_listings"])
    m.staging["stg_calendar"] = staging.stg_calendar(bronze["raw_calendar"])
    m.staging["stg_reviews"] = staging.stg_reviews(bronze["raw_reviews"])
    m.staging["stg_neighbourhoods"] = staging.stg_neighbourhoods(bronze["raw_neighbourhoods"])
    s = m.staging
    dl = dim_listings_override
    if dl is None:
        dl = marts.dim_listings(s["stg_listings"], s["stg_reviews"], s["stg_calendar"], days)
    m.marts["dim_listings"] = dl
    m.marts["dim_hosts"] = marts.dim_hosts(s["stg_listings"])
    m.marts["dim_neighbourhoods"] = marts.dim_neighbourhoods(
        s["stg_neighbourhoods"], s["stg_listings"], default_group)
    m.marts["fct_reviews"] = marts.fct_reviews(s["stg_reviews"], dl)
    m.marts["fct_availability"] = marts.fct_availability(s["stg_calendar"], dl)
    return m


def register_views(spark: SparkSession, models: Models) -> None:
    """Expose every model as a temp view for SQL users."""
    for name, df in {**models.staging, **models.marts}.items():
        df.createOrReplaceTempView(name)


def materialise(spark: SparkSession, bronze: dict[str, DataFrame], gold_dir: str, days: int = 30,
                default_group: str = "London") -> Models:
    """Build and write every mart under ``gold_dir``; return models that read the written tables.

    ``dim_listings`` is written first and read back, so both facts join the
    written table (no recomputation of its three-way join; lineage is cut
    there). Staging stays lazy (views over bronze).
    """
    import os

    from pyspark.sql import functions as F

    from ..sources import files as FS

    first = build(bronze, days, default_group)
    dl_path = os.path.join(gold_dir, "dim_listings")
    FS.write_mart(first.marts["dim_listings"], dl_path, "dim_listings")
    dl = spark.read.parquet(dl_path)
    models = build(bronze, days, default_group, dim_listings_override=dl)
    for name in MART_MODELS:
        if name == "dim_listings":
            continue
        df = models.marts[name]
        p = os.path.join(gold_dir, name)
        FS.write_mart(df, p, name)
        # same column order and types as built (partition columns come back last)
        back = spark.read.parquet(p)
        part = {"year", "month"} if name == "fct_availability" else set()
        models.marts[name] = back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in part
                                           else F.col(f.name) for f in df.schema.fields])
    return models


def run_pipeline(spark: SparkSession, src_dir: str, out_root: str, default_db: str = "rentals",
                 days: int = 30, default_group: str = "London") -> dict[str, str]:
    """Raw files -> bronze Parquet -> staging views -> gold Parquet tables.

    ``out_root`` must be a shared folder on a cluster. Returns mart name -> path.
    """
    import os

    from ..sources import files as FS

    bronze_dir = os.path.join(out_root, target_database(None, default_db) + "_bronze")
    FS.land_bronze(spark, src_dir, bronze_dir)
    bronze = FS.load_bronze(spark, bronze_dir)
    gold_dir = os.path.join(out_root, target_database("gold", default_db))
    models = materialise(spark, bronze, gold_dir, days, default_group)
    register_views(spark, models)
    return {name: os.path.join(gold_dir, name) for name in MART_MODELS}


def publish_tables(spark: SparkSession, models: Models, default_db: str = "rentals") -> dict[str, str]:
    """Save every mart as a catalog table in its layer's database (full overwrite).

    Staging stays a set of views (S6); marts go to ``target_database('gold', ...)``.
    The availability fact is partitioned by year and month. Returns name -> qualified table.
    """
    from ..sources import files as FS

    db = target_database("gold", default_db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    out = {}
    for name in MART_MODELS:
        w = models.marts[name].write.mode("overwrite").format("parquet")
        if name == "fct_availability":
            w = FS.by_month(models.marts[name]).write.mode("overwrite").format("parquet").partitionBy("year", "month")
        w.saveAsTable(f"`{db}`.`{name}`")
        out[name] = f"{db}.{name}"
    register_views(spark, models)
    return out


def run_pipeline_tables(spark: SparkSession, src_dir: str, default_db: str = "rentals", buckets: int | None = None,
                        days: int = 30, default_group: str = "London") -> Models:
    """Catalog-table pipeline with the calendar and ``dim_listings`` bucketed by listing_id.

    A calendar holds one row per listing per date, so no listing can be a hot
    key there. Bucketing both sides of the largest join by listing_id (same
    bucket count) lets ``calendar_metrics`` aggregate and ``fct_availability``
    join without shuffling the calendar. Reviews stay unbucketed, so AQE can
    still split a listing that holds a large share of them.
    """
    from ..sources import files as FS

    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bronze_db = target_database(None, default_db) + "_bronze"
    gold_db = target_database("gold", default_db)
    for db in (bronze_db, gold_db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    bronze = {}
    for name, df in FS.read_raw(spark, src_dir).items():
        w = df.write.mode("overwrite").format("parquet")
        if name == "raw_calendar":
            w = w.bucketBy(n, "listing_id").sortBy("listing_id")
        w.saveAsTable(f"`{bronze_db}`.`{name}`")
        bronze[name] = spark.table(f"`{bronze_db}`.`{name}`")
    first = build(bronze, days, default_group)
    first.marts["dim_listings"].write.mode("overwrite").format("parquet") \
        .bucketBy(n, "listing_id").sortBy("listing_id").saveAsTable(f"`{gold_db}`.`dim_listings`")
    models = build(bronze, days, default_group, dim_listings_override=spark.table(f"`{gold_db}`.`dim_listings`"))
    for name in MART_MODELS:
        if name == "dim_listings":
            continue
        w = models.marts[name]
        if name == "fct_availability":
            FS.by_month(w).write.mode("overwrite").format("parquet") \
                .partitionBy("year", "month").saveAsTable(f"`{gold_db}`.`{name}`")
        else:
            w.write.mode("overwrite").format("parquet").saveAsTable(f"`{gold_db}`.`{name}`")
    register_views(spark, models)
    return models
