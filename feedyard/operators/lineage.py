"""Following a file through the tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedyard.functions.fingerprints import packed, unpacked


def file_lifecycle(inventory: DataFrame, file_log: DataFrame, bronze_counts: DataFrame) -> DataFrame:
    """Per file its inventory state, the span and number of its events, and its rows in bronze.

    Log and bronze are reduced per file before the joins; fingerprints travel packed. Of events of one time an end is later than a start, as
    for blocked files, so that ids of events, which are longer than all else of them, stay behind.
    """
    events = file_log.filter(F.col("file_fingerprint") != "").select(packed(F.col("file_fingerprint")).alias("_print"), "ts_event", "stage_status").groupBy("_print").agg(
        F.count(F.lit(1)).alias("cnt_events"), F.min("ts_event").alias("ts_first"),
        F.max(F.struct("ts_event", F.coalesce(F.col("stage_status") != "STARTED", F.lit(False)).alias("ended"), "stage_status")).alias("_last"))
    key = F.col("_print") if "_print" in bronze_counts.columns else packed(F.col("src_file_fingerprint"))
    counts = bronze_counts.select(key.alias("_print"), F.col("cnt_row_bronze").alias("cnt_found"))
    rows = inventory.select("feed_key", packed(F.col("file_fingerprint"), b"\x03").alias("_print"), "file_path", "load_status", "promote_status", "cnt_row_bronze")
    return rows.join(events, "_print", "left").join(counts, "_print", "left").select(
        unpacked(F.col("_print")).alias("file_fingerprint"), "feed_key", "file_path", "load_status", "promote_status", "cnt_row_bronze",
        "cnt_events", "ts_first", F.col("_last.ts_event").alias("ts_last"), F.col("_last.stage_status").alias("last_status"), "cnt_found")


def stage_counts(file_log: DataFrame) -> DataFrame:
    """Events per hour, stage and status."""
    return file_log.groupBy(F.date_trunc("hour", "ts_event").alias("hour_start"), "stage_name", "stage_status").agg(F.count(F.lit(1)).alias("cnt"))
