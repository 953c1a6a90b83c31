"""Spark session defaults for covariate enrichment jobs.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset, so cluster-wide choices (shuffle partitions,
checkpoint folder, broadcast threshold) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at run time (broadcast when
# a side turns out small, split skewed partitions, coalesce tiny ones).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session has no value yet."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "covspark") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("COVSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.  A cluster
    names it; only a local session without one gets a scratch folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="covspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def join_where_dealt(spark: SparkSession) -> None:
    """Let a join on more columns stay where both sides are already dealt by some of them; by default Spark shuffles both
    again by all."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: the lineage is cut (a later failure recomputes from the files, not
    from the sources) and the plan that follows stays small.  The folder is
    the session's ``spark.checkpoint.dir``; without it only a local session
    goes on."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/covspark-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
