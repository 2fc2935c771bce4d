"""Directory listings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedyard.sources.filesource import FeedFiles


def plain_path(encoded: Column) -> Column:
    """File path as listed, from the URL-encoded form of file metadata; a plus sign stays one."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def is_hidden(name: Column) -> Column:
    """Names that Spark's own file sources leave out."""
    return name.rlike("^[_.]")


def qualified(spark: SparkSession, directory: str) -> str:
    """A folder with scheme and authority, as Spark names the files below it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _as_listing(found: DataFrame) -> DataFrame:
    return found.select("name", F.col("name").alias("file_name"), F.col("path").alias("file_path"), F.col("length").alias("size"),
                        F.col("modified_ms").alias("modificationTime"), "keys")


def list_files(spark: SparkSession, directory: str, partitions: bool = False) -> DataFrame:
    """The files directly in a folder, whatever they are called; no content is read.

    With ``partitions`` the ``key=value`` sub-folders are listed too, each by a task of its own, and their keys become text columns.
    """
    spark.dataSource.register(FeedFiles)
    found = _as_listing(spark.read.format("feed_files").option("path", qualified(spark, directory)).option("partitions", str(partitions)).load())
    if not partitions:
        return found.drop("keys")
    # the keys of a layout are few: they are the names of its columns
    keys = sorted(r["k"] for r in found.select(F.explode(F.map_keys("keys")).alias("k")).distinct().collect())
    return found.select("*", *[F.col("keys").getItem(k).alias(k) for k in keys]).drop("keys")


def stream_files(spark: SparkSession, directory: str, log: str, per_batch: int | None = None) -> DataFrame:
    """New files of a folder as a stream of listing rows. ``log`` is a folder for what this stream has seen."""
    spark.dataSource.register(FeedFiles)
    reader = spark.readStream.format("feed_files").option("path", qualified(spark, directory)).option("log", qualified(spark, log))
    return _as_listing(reader.option("per_batch", str(per_batch or 0)).load()).drop("keys")


def template_glob(template: str, values: dict[str, str]) -> str:
    """Folder pattern from a template such as ``year={yyyy}/month={mm}``; unnamed parts match all."""
    out = template
    for part in ("yyyy", "mm", "dd"):
        out = out.replace("{" + part + "}", values.get(part, "*"))
    return out
