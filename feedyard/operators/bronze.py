"""Bronze rows: lineage, append, counts, deduplication, retention."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedyard import schemas
from feedyard.functions.fingerprints import packed, unpacked
from feedyard.functions.text import col_q
from feedyard.operators import commits
from feedyard.operators.skew import lookup_join


def add_lineage(rows: DataFrame, files: DataFrame, feed_key: str, request_id: str | None, run_id: str | None, now, also: tuple[str, ...] = ()) -> DataFrame:
    """Business columns as text, followed by the technical columns; columns named by ``also`` stay as they are, behind them.

    ``files`` is ``(file_path, file_name, file_fingerprint)``, one row per file of this load; a batch
    is bounded by its file limit, so Spark's own size check decides on the join.
    """
    meta = {"_file_path", "_block_start", "_row_id", *also}
    business = [c for c in rows.columns if c not in meta and c not in schemas.names(schemas.BRONZE_TECHNICAL)]
    known = files.select(F.col("file_path").alias("_file_path"), F.col("file_name").alias("_n"), F.col("file_fingerprint").alias("_fp"))
    return rows.join(known, "_file_path", "left").select(
        *[col_q(c).cast("string").alias(c) for c in business],
        F.lit(feed_key).cast("string").alias("feed_key"), F.lit(request_id).cast("string").alias("request_id"),
        F.lit(run_id).cast("string").alias("dispatch_run_id"), F.col("_n").alias("src_file_name"), F.col("_file_path").alias("src_file_path"),
        F.col("_fp").alias("src_file_fingerprint"), F.lit(now).cast("timestamp").alias("ts_ingest"), *also,
    )


def append_bronze(rows: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Append; columns may differ from earlier appends."""
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)


def read_load(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """What one load wrote; nothing else of the table is read."""
    return spark.read.parquet(commits.part_path(path, load_id))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bronze table that count, columns of all loads united."""
    return commits.committed(spark.read.option("mergeSchema", True).parquet(path), commits.manifests(spark, path))


def partition_columns(spec: str | None) -> list[str]:
    return [c.strip() for c in (spec or "").split(",") if c.strip()]


def with_month(rows: DataFrame, date_column: str, name: str = "date_month") -> DataFrame:
    """Month partition value of a text or date column; what is no date goes to the NULL partition."""
    return rows.withColumn(name, F.date_format(F.trunc(col_q(date_column).try_cast("date"), "month"), "yyyy-MM"))


def bronze_counts(bronze: DataFrame, keyed: bool = False) -> DataFrame:
    """Rows per loaded file. Fingerprints travel packed; ``keyed`` leaves them beside, as ``_print``, for joins by them."""
    print_ = F.col("src_file_fingerprint")
    counts = bronze.select(F.when(print_.isNotNull(), packed(print_)).alias("_print")).groupBy("_print").agg(F.count(F.lit(1)).alias("cnt_row_bronze"))
    return counts.select(unpacked(F.col("_print")).alias("src_file_fingerprint"), "cnt_row_bronze", *(["_print"] if keyed else []))


def dedup_loads(bronze: DataFrame) -> DataFrame:
    """Keep only the first load of each file; a file loaded by several requests would count twice. Fingerprints travel packed."""
    print_ = F.col("src_file_fingerprint")
    rows = bronze.withColumn("_print", F.when(print_.isNotNull(), packed(print_))).drop("src_file_fingerprint")
    first = rows.groupBy("_print").agg(
        F.min_by("request_id", F.struct("ts_ingest", "request_id")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    marked = lookup_join(rows, first, ["_print"], "_n").filter(F.col("request_id").eqNullSafe(F.col("_first")))
    return marked.withColumn("src_file_fingerprint", unpacked(F.col("_print"))).select(*bronze.columns)


def apply_retention(bronze: DataFrame, config: DataFrame, now, ts: str = "ts_ingest") -> DataFrame:
    """Drop rows older than their feed's ``gov_retention_days``; feeds without one keep all."""
    # rows do not say which sub-feed they are of, so the longest term of a feed holds
    days = config.filter(F.col("gov_retention_days") > 0).groupBy("feed_key").agg(F.max("gov_retention_days").alias("gov_retention_days"))
    aged = bronze.join(days, "feed_key", "left")
    keep = F.col("gov_retention_days").isNull() | (F.col(ts) >= F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.col("gov_retention_days").cast("int")))
    return aged.filter(keep).drop("gov_retention_days")
