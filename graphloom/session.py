"""Session defaults and lineage cuts shared by the iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("graphloom")
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("GRAPHLOOM_DRIVER_MEMORY", "12g")
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster executors do not share one.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="graphloom-"))
    return context.getCheckpointDir().rstrip("/")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use all cores for a scan that has fewer splits than the cluster has cores; otherwise the frame itself.

    Text work costs far more than the bytes suggest, so a small file in one split is worth one small shuffle. A large
    table has splits enough and is not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a written table, so that a lost executor never replays earlier rounds.

    Reading the table back also gives the optimizer true sizes for the next join.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/graphloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
