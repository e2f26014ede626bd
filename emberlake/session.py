"""Session defaults shared by the entry point, the tests and the bench."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Planner settings the operators rely on. Sizes stay with the cluster's own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8,000 bytecodes. Beyond that size Spark's split
    # projections run about three times faster than one huge fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

TASK_ROWS = 500_000  # rows of a dealt table per task
FULL_TASK = 1 << 20  # rows that a task reading a table's files may have before the table is dealt
KEPT = "zstd"  # codec of tables that a session keeps for its own steps


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("emberlake")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` or the context's checkpoint
    folder. Only a local session may do without; it gets a folder of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="emberlake-"))
    return context.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back: it is computed once, and a lost
    executor costs its own tasks only."""
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/steps/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", KEPT).parquet(place)
    release(spark)
    return spark.read.schema(df.schema).parquet(place)


def release(spark: SparkSession) -> None:
    """Once a step is written nothing needs its shuffle files, but Spark removes them only when the
    JVM has collected its garbage. A driver that does little itself may not do so for half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a table to all cores, and to more tasks the more rows there are, unless reading its files
    does so already; a file cannot always be split, and a task that sorts more than its memory holds
    spills. A shuffle of the whole table stays on disk as long as its query runs.

    Rows go by their ``keys``: dealing them in turn would sort each task's whole part first."""
    read = df.groupBy(F.spark_partition_id().alias("task")).count().agg(
        F.count("*").alias("tasks"), F.coalesce(F.max("count"), F.lit(0)).alias("fullest"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if read["tasks"] >= cores and read["fullest"] <= FULL_TASK:
        return df
    return df.repartition(max(cores, -(-read["rows"] // TASK_ROWS)), *keys)
