"""Session helpers: build a local session for tests/bench, find the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "chronofit") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: HotSpot compiles no method beyond this size; Spark's default (65,535) leaves such ones to the interpreter.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; only a local session may get a scratch one.

    On a cluster the folder must be shared storage named by the operator, so an
    unset value there is an error rather than a silent machine-local folder.
    """
    spark.conf.set(*HUGE_METHOD)
    current = checkpoint_dir(spark)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="chronofit-ckpt-", dir=os.environ.get("CHRONOFIT_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
