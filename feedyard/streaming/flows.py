"""The polling stages as streams, thin over the batch operators.

Every flow uses ``availableNow``: it takes what has arrived since its checkpoint and ends, so the
same code serves a schedule or, with another trigger, a running stream.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedyard.functions.fingerprints import enrich_listing
from feedyard.plans.ingest import Feed, LoadFailed, load
from feedyard.sources.listing import stream_files

WINDOW = "48 hours"


def arriving_files(spark: SparkSession, directory: str, log: str, per_batch: int | None = None) -> DataFrame:
    """New files of a folder as listing rows, whatever they are called; contents are not read."""
    return stream_files(spark, directory, log, per_batch)


def drop_known_files(events: DataFrame, ts: str = "ts_event", within: str = WINDOW) -> DataFrame:
    """One row per fingerprint within the watermark: the already-done check on a stream."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark(["file_fingerprint"])


def stage_counts(events: DataFrame, delay: str = "1 hour", size: str = "1 hour") -> DataFrame:
    """Events per window, stage and status; late events count until the watermark passes."""
    counted = events.withWatermark("ts_event", delay).groupBy(F.window("ts_event", size), "stage_name", "stage_status").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(F.col("window.start").alias("hour_start"), "stage_name", "stage_status", "cnt")


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(
        availableNow=True).start().awaitTermination()


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, again: bool = False) -> None:
    """Run micro-batches until the input is taken. With ``again`` the query is started anew until it finds nothing: for a source that gives
    a bounded part of its input at a time.
    """
    ran = True

    def noting(batch: DataFrame, number: int) -> None:
        nonlocal ran
        ran = True
        step(batch, number)

    while ran:
        ran = False
        stream.writeStream.foreachBatch(noting).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        ran = ran and again


def ingest_arrivals(spark: SparkSession, feed: Feed, directory: str, bronze_path: str, log_dir: str, checkpoint: str, now,
                    per_batch: int | None = None, run_id: str | None = None, **how) -> None:
    """Load files as they arrive, each micro-batch as one load with all that a load writes: rows, logs, drift, columns, file states.

    A load is named by the stream's checkpoint and the number of the micro-batch. One that died and is repeated replaces
    its parts, and only its manifest, written last, makes them count, so no file is loaded or logged twice and no other
    stream's rows are touched. Files that cannot be read are logged as failed, also when that is all of a micro-batch. ``how``
    are further arguments of ``plans.ingest.load``.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        try:
            load(batch.sparkSession, feed, enrich_listing(batch), bronze_path, log_dir, f"batch_{number:03d}", f"stream_{number}", run_id, now,
                 load_id=f"{stream}-{number}", **how)
        except LoadFailed:
            pass  # it is logged, and its files are marked as failed

    run_batches(arriving_files(spark, directory, f"{checkpoint}/arrivals", per_batch), step, checkpoint, again=bool(per_batch))
