"""Configuration CSV files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedyard.functions.paths import base_name
from feedyard.sources.delimited import read_headers
from feedyard.sources.listing import is_hidden, list_files, plain_path


def scan_config(spark: SparkSession, directory: str) -> DataFrame:
    """Raw rows of all ``*.csv`` files of a folder by column name, with their file, its time and row order.

    Names that begin with ``_`` or ``.`` are drafts, not configuration. Files may differ in columns: those of one header are read together and united by name.
    """
    files = list_files(spark, directory).filter(F.lower("file_name").endswith(".csv") & ~is_hidden(F.col("file_name")))
    heads = read_headers(files, ",").filter(F.col("error").isNull() & (F.size("columns") > 0))
    # one entry per distinct header, with the files that have it
    groups = heads.groupBy("first_line").agg(F.collect_list("file_path").alias("paths")).collect()
    parts = []
    for g in groups:
        df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(list(g["paths"]))
        clean = {c: c.strip().lstrip("\ufeff") for c in df.columns}
        parts.append(df.select(
            *[F.col(f"`{c}`").alias(n) for c, n in clean.items()],
            base_name(plain_path(F.col("_metadata.file_path"))).alias("config_source_file"),
            F.col("_metadata.file_modification_time").alias("config_source_mtime"), F.monotonically_increasing_id().alias("row_no")))
    if not parts:
        return spark.createDataFrame([], "feed_key string, config_source_file string, config_source_mtime timestamp, row_no bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
