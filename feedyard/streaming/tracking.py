"""The latest status per identity as keyed state that expires, and its read from the state itself."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedyard.operators.waterfall import identity

HOURS = 48
# Versions of the state that a restart may need; older ones are removed by the maintenance, which has to come round in short runs too.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}


@contextmanager
def state_settings(spark: SparkSession, **more: str) -> Iterator[None]:
    """State in RocksDB, of few versions, while a query starts and runs."""
    wanted = STATE | more
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def track_latest(stream: DataFrame, checkpoint: str, hours: int = HOURS) -> None:
    """Keep the latest status per identity, forgetting what is older than ``hours`` before the newest event.

    The table is the query's own state below ``checkpoint``: the newest event per identity and span of ``hours``, a span being forgotten
    when the watermark passes its end, so it grows with the identities of at most three spans and not with the micro-batches. Events are
    reduced before the shuffle, so one identity of very many is not one task's work. An event of a span that is gone is dropped. Events
    without time or identity are not tracked.
    """
    events = stream.withColumn("identity", identity(stream)).filter("ts_event IS NOT NULL AND coalesce(identity, '') <> ''")
    # an event is in the window still when it equals the watermark, so that stands one millisecond further back
    latest = F.max(F.struct(F.unix_micros("ts_event").alias("at"), F.col("event_id").cast("string").alias("event_id"), "stage_status"))
    tracked = events.withWatermark("ts_event", f"{hours} hours 1 millisecond").groupBy("identity", F.window("ts_event", f"{hours} hours")).agg(latest.alias("latest"))
    with state_settings(stream.sparkSession):
        tracked.writeStream.format("noop").option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start().awaitTermination()


def tracked_status(spark: SparkSession, checkpoint: str, hours: int = HOURS) -> DataFrame:
    """``(identity, ts_event, event_id, stage_status)``: the latest event of each identity within the window, read in parallel from the state."""
    state = spark.read.format("statestore").load(checkpoint)
    parts = state.select("key.identity", F.col("value.max").alias("latest"))
    newest = parts.agg(F.max("latest.at").alias("newest")).first()["newest"]  # one number
    recent = parts.filter(F.col("latest.at") >= F.lit(newest) - hours * 3_600_000_000)
    top = recent.groupBy("identity").agg(F.max("latest").alias("top"))
    return top.select("identity", F.timestamp_micros("top.at").alias("ts_event"), "top.event_id", "top.stage_status")


def current_blocked(spark: SparkSession, checkpoint: str, hours: int = HOURS) -> DataFrame:
    """Identities whose latest tracked status is a start without an end."""
    return tracked_status(spark, checkpoint, hours).filter("stage_status = 'STARTED'").select("identity")


def count_stages(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Run a windowed count: windows that the watermark closes go to ``path``, the others stay in the state below ``checkpoint``."""
    with state_settings(counts.sparkSession):
        counts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(
            availableNow=True).start().awaitTermination()


def counted_stages(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """All windows so far: the closed ones as written and the open ones from the state. A window is in one of them only, as it leaves the state when it is written."""
    closed = spark.read.schema("hour_start timestamp, stage_name string, stage_status string, cnt bigint").parquet(path)
    state = spark.read.format("statestore").load(checkpoint)
    open_ = state.select("key.*", F.col("value.count").alias("cnt")).toDF("window", "stage_name", "stage_status", "cnt")
    return closed.unionByName(open_.select(F.col("window.start").alias("hour_start"), "stage_name", "stage_status", "cnt"))
