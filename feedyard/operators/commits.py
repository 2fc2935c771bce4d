"""One commit per load: each table of a load has a part of its own, and a manifest, written last, makes all of them count.

A load writes its part of bronze and of every log into a folder named by the load, replacing what an earlier attempt
left there. Then its manifest goes beside the bronze table. Readers follow the manifests: parts without one are those of
a load that died, and its repetition replaces them. Loads share no file, so two at a time take nothing from each other.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedyard import schemas
from feedyard.functions.text import col_q

LOAD = "load_id"  # folder level of a table, one value per load; not a column of its rows
# A folder that Spark's own readers of the table do not look into.
MANIFESTS = "_loads"
# Rows of a log that belong to no load, and of the part that a load writes before it reads anything.
NO_LOAD, BEGAN = "none", "begun"
MANIFEST = schemas.INVENTORY + ", dq_status string, succeeded boolean, ended timestamp, columns array<string>"


def load_name(feed_key: str, request_id: str | None, run_id: str | None, batch_id: str, refs: DataFrame) -> str:
    """The same for the same files of the same batch, so that a repeated load replaces its first attempt."""
    files = refs.agg(F.bit_xor(F.xxhash64("file_fingerprint")).alias("x"), F.count(F.lit(1)).alias("n")).first()
    return hashlib.sha256("|".join(map(str, (feed_key, request_id, run_id, batch_id, files["x"], files["n"]))).encode()).hexdigest()[:24]


def part_path(path: str, load_id: str) -> str:
    # a letter in front, so that no id is read back as a number or a date
    return f"{path}/{LOAD}=load-{load_id}"


def write_part(rows: DataFrame, path: str, load_id: str, partition_cols: list[str] | None = None) -> None:
    """Write one load's part of a table; the same load written again replaces itself."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(part_path(path, load_id))


def publish(files: DataFrame, table: str, load_id: str, columns: list[str]) -> None:
    """The manifest: one row per file of the load with what it became, and one with the business columns the table has since.

    ``files`` has inventory columns, as far as they are known, and ``succeeded`` and ``ended``. What is written here is
    what the load did; without it nothing of the load counts.
    """
    have = set(files.columns) - {"columns"}  # a file's own header is not the table's
    rows = files.select([(col_q(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in schemas.fields(MANIFEST)])
    head = rows.agg(F.max("ended").alias("ended")).select([
        (F.col("ended") if n == "ended" else F.array(*map(F.lit, columns)) if n == "columns" else F.lit(None)).cast(t).alias(n) for n, t in schemas.fields(MANIFEST)])
    write_part(rows.unionByName(head), f"{table}/{MANIFESTS}", load_id)


def manifests(spark: SparkSession, table: str) -> DataFrame | None:
    """The manifest rows of all loads of a table, with their ``load_id``; None where it has none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{MANIFESTS}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(f"{MANIFEST}, {LOAD} string").option("basePath", f"{table}/{MANIFESTS}").parquet(f"{table}/{MANIFESTS}/*")


def is_head() -> Column:
    """Whether a manifest row is that of the load as a whole."""
    return F.col("columns").isNotNull()


def committed(rows: DataFrame, done: DataFrame | None) -> DataFrame:
    """Rows of a table or log that count: those of committed loads, of no load, and of what loads log as they begin."""
    if LOAD not in rows.columns:
        return rows
    own = F.col(LOAD).isNull() | F.col(LOAD).isin(f"load-{NO_LOAD}") | F.col(LOAD).endswith(f".{BEGAN}")
    if done is None:
        return rows.filter(own).drop(LOAD)
    ids = done.filter(is_head()).select(F.col(LOAD).alias("_done")).distinct()
    return rows.join(ids, F.col(LOAD) == F.col("_done"), "left").filter(own | F.col("_done").isNotNull()).drop(LOAD, "_done")


def known_columns(spark: SparkSession, table: str, but: str | None = None) -> list[str] | None:
    """Business columns of a table in the order in which loads brought them; None before the first load.

    Names that differ only in case are one, spelled as at first. ``but`` leaves out one load: the attempt that is repeated.
    """
    rows = manifests(spark, table)
    if rows is None:
        return None
    heads = rows.filter(is_head() & (F.col(LOAD) != f"load-{but}"))
    names = heads.select("ended", LOAD, F.posexplode("columns").alias("n", "name")).groupBy(F.lower("name")).agg(F.min(F.struct("ended", LOAD, "n", "name")).alias("first"))
    found = names.orderBy("first").select("first.name").collect()  # the width of the table, whatever the number of loads
    return [r["name"] for r in found] if found or not heads.isEmpty() else None


def loaded_files(spark: SparkSession, table: str) -> DataFrame | None:
    """What the last load that decided about a file made of it, with inventory columns, ``dq_status`` and ``ended``; None before the first load.

    A file is decided by a load that brought its rows and by one whose rules it failed; one that could not be read is not.
    """
    rows = manifests(spark, table)
    if rows is None:
        return None
    cells = [n for n in schemas.names(MANIFEST) if n not in ("file_fingerprint", "columns", "succeeded")]
    decided = rows.filter(~is_head() & (F.col("succeeded") | (F.col("dq_status") == "FAILED")))
    last = decided.groupBy("file_fingerprint").agg(F.max_by(F.struct(*cells), F.struct("ended", LOAD)).alias("last"))
    return last.select("file_fingerprint", "last.*")
