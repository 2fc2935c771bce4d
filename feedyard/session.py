"""Session construction and the shared scratch folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "feedyard", shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the operators assume; on a cluster leave ``master`` unset."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a skewed side even when an aggregate above it then needs one more shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # streams run until their input is taken and end; old versions of state have to go within such a run
        .config("spark.sql.streaming.stateStore.maintenanceInterval", "5s")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("FEEDYARD_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset (local tests) a temporary folder is made and used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = getattr(spark, "_feedyard_shared_dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="feedyard-")
        spark._feedyard_shared_dir = base
    return base


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name of the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame) -> DataFrame:
    """Write wide rows once, in compressed columns, to the shared folder and read them from there: lost executors cannot change them either."""
    path = work_dir(df.sparkSession, "kept")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so that lost executors cannot change row placement."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(f"{shared_dir(spark).rstrip('/')}/checkpoints")
    return df.checkpoint(eager=True)
