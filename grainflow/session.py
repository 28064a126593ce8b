"""Session helpers: a tuned local session, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def get_spark(app: str = "grainflow", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and bench.py use."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRAINFLOW_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _one_machine(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    Only where that setting is absent and everything runs on one machine (local mode) a temporary
    folder is made and set; it is removed when the process ends.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not _one_machine(spark):
            raise ValueError("a cluster needs spark.checkpoint.dir, a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="grainflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        at = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def require_shared(spark: SparkSession, path: str = "") -> str:
    """Sets spark.checkpoint.dir to path if it is unset. Raises ValueError without either, unless everything
    runs on this machine."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if path:
            spark.conf.set("spark.checkpoint.dir", path)
        elif not _one_machine(spark):
            raise ValueError("a cluster needs spark.checkpoint.dir (or --shared), a folder that all executors share")
    return shared_dir(spark)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """df, written once as a Parquet table in the shared folder and read back.

    Cuts the lineage, survives the loss of executors, and gives the planner real sizes, so that
    it broadcasts a side only if the file is below spark.sql.autoBroadcastJoinThreshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_counted(df: DataFrame, name: str, **what: Column) -> tuple[DataFrame, dict[str, int]]:
    """stored(), and aggregates of its rows that are observed while they are written, without another job."""
    seen = Observation()
    out = stored(df.observe(seen, *(c.alias(k) for k, c in what.items())), name)
    return out, seen.get
