"""Log records and notifications."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedyard import schemas
from feedyard.functions.text import blank_to_null
from feedyard.operators import commits


def new_id() -> Column:
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def shape(df: DataFrame, ddl: str, **values) -> DataFrame:
    """Rows in the exact columns of a table: given values first, then columns of that name, else NULL.

    A missing ``event_id`` is generated.
    """
    have = set(df.columns)
    cells = []
    for name, kind in schemas.fields(ddl):
        if name in values:
            value = values[name] if isinstance(values[name], Column) else F.lit(values[name])
        elif name in have:
            value = F.col(name)
        else:
            value = new_id() if name == "event_id" else F.lit(None)
        cells.append(value.cast(kind).alias(name))
    return df.select(cells)


def _at(now) -> Column:
    return (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")


def job_log(df: DataFrame, now, **values) -> DataFrame:
    return shape(df, schemas.JOB_LOG, ts_event=_at(now), **values)


def file_log(df: DataFrame, now, **values) -> DataFrame:
    values.setdefault("file_fingerprint", F.coalesce("file_fingerprint", F.lit("")))
    return shape(df, schemas.FILE_LOG, ts_event=_at(now), **values)


def schema_change_log(df: DataFrame, now, **values) -> DataFrame:
    return shape(
        df, schemas.SCHEMA_CHANGE_LOG, ts_event=_at(now), file_fingerprint=F.coalesce("file_fingerprint", F.lit("")),
        source_columns_csv=F.array_join("source_columns", ","), target_columns_csv=F.array_join("target_columns", ","), **values)


def discovery_log(df: DataFrame, now, **values) -> DataFrame:
    return shape(df, schemas.DISCOVERY_LOG, ts_event=_at(now), file_fingerprint=F.coalesce("file_fingerprint", F.lit("")),
                 status_reason="DISCOVERY scaffold only; no bronze ingest performed", **values)


def recipients(feed: Column, override: Column | str | None) -> Column:
    """The environment's override, else the feed's own recipients, else none."""
    other = override if isinstance(override, Column) else F.lit(override).cast("string")
    return F.coalesce(blank_to_null(other), blank_to_null(feed))


def notifications(df: DataFrame, now, **values) -> DataFrame:
    """Notification rows; severities and categories outside the vocabulary fail the job.

    ``details`` may name a struct column, which becomes JSON.
    """
    def allowed(name: str, words: tuple[str, ...]) -> Column:
        raw = values.pop(name) if name in values else F.col(name)
        word = F.upper(F.trim(raw if isinstance(raw, Column) else F.lit(raw)))
        return F.when(word.isin(*words), word).otherwise(F.raise_error(F.concat(F.lit(f"invalid {name}: "), F.coalesce(word, F.lit("NULL")))))

    severity, category = allowed("severity", schemas.SEVERITIES), allowed("category", schemas.CATEGORIES)
    event = values.pop("event_type", F.col("event_type") if "event_type" in df.columns else None)
    extra = {"details_json": F.to_json("details")} if "details" in df.columns else {}
    for name in ("feed_key", "dispatch_run_id", "request_id"):
        if name not in values and name in df.columns:
            values[name] = blank_to_null(F.col(name)) if name != "feed_key" else F.nullif(F.col(name), F.lit(""))
    return shape(df, schemas.NOTIFICATIONS, severity=severity, category=category,
                 event_type=F.upper(F.trim(event if isinstance(event, Column) else F.lit(event))), ts_event=_at(now), **extra, **values)


def valid_notification(severity: Column, category: Column) -> Column:
    return F.upper(F.trim(severity)).isin(*schemas.SEVERITIES) & F.upper(F.trim(category)).isin(*schemas.CATEGORIES)


def append_log(df: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append to a log; nothing is written for no rows. The rows of a load replace those of its earlier attempt."""
    if load_id:
        commits.write_part(df, path, load_id)
    elif not df.isEmpty():
        df.write.mode("append").parquet(commits.part_path(path, commits.NO_LOAD))


def read_log(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """The rows of a log that count; ``table`` is the bronze table whose loads wrote to it."""
    return commits.committed(spark.read.parquet(path), commits.manifests(spark, table) if table else None)


def recent(log: DataFrame, n: int, now=None, hours: int | None = None, severity: str | None = None) -> DataFrame:
    """The newest ``n`` rows, optionally of the last hours and of one severity."""
    if hours is not None:
        log = log.filter(F.col("ts_event") >= F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours)))
    if severity is not None:
        log = log.filter(F.col("severity") == severity)
    return log.orderBy(F.desc("ts_event"), F.desc("event_id")).limit(n)


def outbox(log: DataFrame, deliveries: DataFrame, channels: DataFrame) -> DataFrame:
    """Notifications not yet delivered, per channel that wants their severity."""
    due = log.join(channels, "severity")
    sent = deliveries.filter(F.col("delivery_status") == "SENT").select("event_id", "channel")
    return due.join(sent, ["event_id", "channel"], "left_anti")


def batch_status(file_results: DataFrame) -> DataFrame:
    """Outcome per batch from one row per file with ``succeeded`` and ``cnt_row_written``."""
    out = file_results.groupBy("feed_key", "batch_id").agg(
        F.count(F.lit(1)).alias("file_count"), F.count_if("succeeded").alias("succeeded"), F.count_if(~F.col("succeeded")).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("succeeded"), F.col("cnt_row_written"))), F.lit(0)).alias("total_rows_written"))
    status = F.when(F.col("failed") == 0, "SUCCEEDED").when(F.col("succeeded") > 0, "PARTIAL").otherwise("FAILED")
    reason = F.concat(F.lit("batch_id="), "batch_id", F.lit("; file_count="), "file_count", F.lit("; succeeded="), "succeeded",
                      F.lit("; failed="), "failed", F.lit("; total_rows_written="), "total_rows_written")
    return out.withColumns({"task_status": status, "status_reason": reason})
