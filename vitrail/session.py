"""Session helpers: building a local session and locating shared scratch space.

Library code never invents a folder: anything written during a job (checkpoints, model and
file round trips) goes below the directory the session names in ``spark.checkpoint.dir``,
or else below its warehouse, which all executors share as well.  Whoever takes a scratch
path removes it (:func:`remove_path`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "vitrail") -> SparkSession:
    """A local session tuned for tests and the bench (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # remove reliable checkpoint files once nothing references them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the session names, if any."""
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if not value:
        value = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The SparkContext's checkpoint folder, registered first where it is not yet: the
    session's ``spark.checkpoint.dir``, else a folder of its warehouse."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = checkpoint_dir(spark)
    if target is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder shared by the cluster (HDFS, object store)")
        target = f"{warehouse.rstrip('/')}/vitrail-checkpoints"
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below the shared checkpoint folder for files a job writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vitrail-scratch/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever the session's file systems keep it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives executor loss (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
