"""SparkSession construction and lineage-cut helpers."""

from __future__ import annotations

import os
import sysconfig
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "staylytics", driver_memory: str | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join), UTC, no UI.

    On a cluster the master and resources come from spark-submit; the
    explicit ``master`` is for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("STAYLYTICS_MASTER")
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or int(os.environ.get("STAYLYTICS_SHUFFLE_PARTITIONS", "0") or 0)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no page shows what is over: a long session does not keep it on the driver
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "100")
        .config("spark.ui.retainedTasks", "2000")
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; only a local session (tests, bench) without one
    gets a fresh scratch folder. A cluster session without it is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        configured = tempfile.mkdtemp(prefix="staylytics-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def ship_package(spark: SparkSession) -> None:
    """For jobs with Python in their tasks: send this package where the workers would not find it.

    It is neither installed nor on PYTHONPATH then. Spark serves the file.
    """
    package = Path(__file__).resolve().parent
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *sysconfig.get_paths().values()]
    sc = spark.sparkContext
    if str(package.parent) in map(os.path.realpath, found) or getattr(sc, "_staylytics_sent", False):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="staylytics-code-"), "staylytics.zip")
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(name)
    sc._staylytics_sent = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
