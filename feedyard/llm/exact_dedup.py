"""Exact deduplication as a stream with keyed state on disk that never expires. DataFrame functions only."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedyard.session import stable, work_dir

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commits write what changed, and files are not allocated ahead: a small state stays small however many partitions it has
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # a store is closed when its task ends; otherwise all stores of an executor stay open in native memory while later stages run
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text_col: str) -> Column:
    """Each run of white space becomes one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))

# Bytes of the table per state store, up to one store per shuffle partition.
STORE_BYTES = 64 << 20


def _locator(id_col: str) -> Column:
    """Orders rows by id (NULL last), then by where they stand; no two rows of a table are equal in it."""
    return F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).cast("bigint").alias("id"),
                    F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def update_state(spark: SparkSession, path: str, state_dir: str, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256, bytes_per_trigger: int = 1 << 40) -> None:
    """Stream the Parquet table at ``path`` into the state kept in ``state_dir``.

    The state has one entry per digest: the smallest identifier with the locator (file, row) of its text, and the
    count of rows. It has no watermark, so it never expires; RocksDB holds it on the executors' disks and every
    micro-batch of at most ``bytes_per_trigger`` commits it to ``state_dir``. A second call over the same folder
    reads only files that are new. Rows are reduced per task before they reach the state, so one text that makes
    up a third of all rows sends one row per task.
    """
    names = spark.read.parquet(path).schema
    # a small table needs no store per shuffle partition: each is a RocksDB of its own, with memory and files; a state keeps the number it began with
    size = int(str(spark.read.parquet(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    stores = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // STORE_BYTES)))
    settings = ROCKSDB | {"spark.sql.shuffle.partitions": str(stores)}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # the last letter as a pattern: a stream takes a single file only through one
        rows = spark.readStream.schema(names).option("maxBytesPerTrigger", str(bytes_per_trigger)).parquet(f"{path[:-1]}[{path[-1]}]")
        seen = rows.select(digest(normalised(text_col)).alias("digest"), _locator(id_col).alias("at"))
        kept = seen.groupBy("digest").agg(F.min("at").alias("keeper"), F.count(F.lit(1)).alias("n"))
        query = (kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", state_dir)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """``(digest, keeper, n)``, read in parallel from the committed state."""
    state = spark.read.format("statestore").load(state_dir)
    return state.select(F.col("key.*"), F.col("value.*")).toDF("digest", "keeper", "n")


def judge(spark: SparkSession, path: str, state: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Every row of the table with its verdict: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    A row whose digest occurs more than once is a hit. The full texts behind each such digest are compared; where
    they differ, the digest lied and its rows are grouped anew by the texts themselves.
    """
    text = normalised(text_col)
    rows = spark.read.parquet(path).select(text.alias("body"), _locator(id_col).alias("at"))
    rows = rows.select("at", "body", digest(F.col("body")).alias("digest"), F.sha2(F.col("body").cast("binary"), 256).alias("sha"))
    met = rows.join(state, "digest", "left")
    met = stable(met.select("digest", "at", "sha", "keeper", "n", F.when(F.col("n") > 1, F.col("body")).alias("body")))
    lying = (met.filter("n > 1").groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
             .filter("low <> high").select("digest"))
    if not lying.isEmpty():
        texts = met.join(lying, "digest", "left_semi").groupBy("digest", "body").agg(
            F.min("at").alias("own_keeper"), F.count(F.lit(1)).alias("own_n"))
        met = met.join(texts, ["digest", "body"], "left").withColumns(
            {"keeper": F.coalesce("own_keeper", "keeper"), "n": F.coalesce("own_n", "n")})
    return met.select(F.col("at.id").alias("doc_id"), F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("at") == F.col("keeper")).alias("kept"), F.col("sha").alias("text_sha256"),
                      F.col("at.file").alias("file"), F.col("at.row").alias("row"))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, state_dir: str | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``, dropped ones too.

    ``doc_id, keep_id, group_size, kept, text_sha256``, and ``file, row``, which name the row even where ids do not.
    Texts are equal when identical after each run of white space became one space; the smallest id stays. NULL text
    counts as empty. A NULL id sorts last, so it stays only where no equal text has an id. Of repeated rows with one
    id the first by place stays, the others have ``kept`` false. An empty table gives no rows.
    """
    state_dir = state_dir or work_dir(spark, "dedup-state")
    update_state(spark, path, state_dir, id_col, text_col, digest)
    return judge(spark, path, read_state(spark, state_dir), id_col, text_col, digest)


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns and other rows as they are.

    The rows are written to the shared folder first, so that each has a place that the state can name.
    """
    path = work_dir(spark, "dedup-rows")
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # clashing names of other columns cannot matter
    named.write.parquet(path)
    col = {c: n for c, n in zip(docs.columns, named.columns)}
    verdict = exact_dedup(spark, path, col[id_col], col[text_col]).filter("kept").select(
        F.col("file").alias("_llm_file"), F.col("row").alias("_llm_row"))
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_llm_f"), F.col("_metadata.row_index").alias("_llm_r"))
    kept = rows.join(verdict, (F.col("_llm_f") == F.col("_llm_file")) & (F.col("_llm_r") == F.col("_llm_row")), "left_semi")
    return kept.drop("_llm_f", "_llm_r").toDF(*docs.columns)
