"""Incremental loads as a file stream: each micro-batch runs the same validation, change
detection and merge as a batch load. Replays are harmless (same key and hash = unchanged) and
late rows are plain updates, so there is no watermark: the state is the staging table."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.normalize import SEQ
from emberlake.plans.pipeline import RunOptions, Warehouse
from emberlake.sources.readers import with_arrival

PLACE = ("file_modification_time", "file_path", "file_block_start")


def stream_files(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 100,
    max_file_age: str = "36500d",
) -> DataFrame:
    """Rows of landed files with the place they arrived at, which ``load_stream`` orders by. Spark
    skips files older than ``max_file_age`` before the newest; late files are wanted here."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", max_file_age)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path).select("*", *[F.col(f"_metadata.{p}").alias(f"_{p}") for p in PLACE])


def arrival(batch: DataFrame, batch_id: int) -> DataFrame:
    """Arrival numbers of a micro-batch: batches in turn, inside one older files first, then by path
    and place in the file, however Spark packs files into tasks. A stream of other origin is
    numbered as it stands."""
    first = batch_id << 42
    places = [f"_{p}" for p in PLACE]
    if not set(places) <= set(batch.columns):
        return batch.withColumn(SEQ, F.lit(first) + F.monotonically_increasing_id())
    marked = batch.withColumn("_at", F.monotonically_increasing_id())
    return with_arrival(marked, [*places, "_at"], first).drop(*places, "_at")


def load_stream(
    warehouse: Warehouse, source: str, stream: DataFrame, checkpoint: str,
    options: RunOptions = RunOptions(), promote: bool = True,
) -> list[dict]:
    """Process everything available, one audited load per micro-batch, then promote once."""
    results: list[dict] = []
    # Batches stop at staging; their promotion waits until the query has finished, also if that
    # takes another call.
    staged_only = replace(options, promote=False)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # A batch that is retried keeps its run: the checkpoint names the query, the number the batch.
        run_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}#{source}#{batch_id}"))
        results.append(warehouse.load(source, arrival(batch, batch_id), staged_only, run_id))

    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if promote and not options.smoke:
        warehouse.promote_pending(source)
    return results
