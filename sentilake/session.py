"""Session settings the operators are written for."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the call site of every column operation slows down building large expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "sentilake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; a local cluster's are not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`. Only a local session may fall back to a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not is_local(spark):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="sentilake-")
        sc.setCheckpointDir(folder)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a reused result to the cluster's checkpoint folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a reused result of many rows as Parquet in the shared folder and read it back.

    A checkpoint serializes every row as an object of its own. The order of rows and the partitions are not kept.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a frame with fewer partitions than cores by a hash of its unique key.

    A file written as one row group is a single task however it is split, and small
    results are merged into few partitions although each row may mean much work. Inputs
    with enough splits are left alone: no shuffle. Meant for scans and materialized
    frames, whose partitions are known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
