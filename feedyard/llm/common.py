"""What the training-data operators share: reading the working columns, bounded chunks inside tasks, tables and sums that spread a hot group."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedyard.session import stable, work_dir

# Bytes of text that a task holds decoded at a time; one longer text makes a chunk of its own.
CHUNK_BYTES = 2 << 20
# Bytes of rows that go to a Python worker at a time; Spark's own bound counts 10 000 rows, which the JVM and the worker then hold more than once.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's rows go to Python workers in batches of about ``BATCH_BYTES``, or of what it had set if that is less."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id bigint, body binary)`` of all rows; other columns, whatever their names, are left behind. NULL text is empty."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))


def chunks(batches: Iterable[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and bodies of Arrow batches (columns id and body) in pieces of about ``size`` bytes."""
    ids, bodies, held = [], [], 0
    for batch in batches:
        for i, body in zip(batch.column(0), batch.column(1)):
            ids.append(i.as_py())
            bodies.append(body.as_py())
            held += len(bodies[-1])
            if held >= size:
                yield ids, bodies
                ids, bodies, held = [], [], 0
    if ids:
        yield ids, bodies
    # workers serve one stage after another: what Arrow holds free is given back
    pa.default_memory_pool().release_unused()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, with a size that Spark knows when it chooses a join."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def source_key(source: str | Column) -> list[Column]:
    """``nameless`` and ``name`` of a source, neither of them NULL; ordered by both, named sources come first and by code point."""
    source = (F.col(source) if isinstance(source, str) else source).cast("string")
    return [source.isNull().alias("nameless"), F.coalesce(source, F.lit("")).alias("name")]


def running_sum(df: DataFrame, group: str, order: list[Column], values: dict[str, str]) -> DataFrame:
    """Add to each row its 0-based ``place`` within its group and, for each column in ``values``, the sum over the group's earlier rows.

    ``values`` maps column to name of the sum; ``group`` is a bigint column without NULL. A group of any size spans many
    tasks: rows are range-partitioned and sorted, each task sums its own runs of a group, and the base of each run is
    a running sum over the runs, of which a group has at most one per task. Rows equal in ``order`` stand as they were read, so
    equal rows do not meet in one task either. The sorted rows are checkpointed: both passes see the same placement.
    """
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, sums = None, 0, dict.fromkeys(values, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column(group).to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[g[0] != key], g[1:] != g[:-1]])
            run, first = np.cumsum(fresh), np.flatnonzero(fresh)  # run 0 goes on from the batch before
            at = np.arange(len(g))
            places = at - np.concatenate([[-place], first])[run]
            added = [pa.array(places, pa.int64())]
            for c in values:
                v = batch.column(c).to_numpy(zero_copy_only=False)
                before = np.cumsum(v) - v
                before = before - np.concatenate([[-sums[c]], before[first]])[run]
                added.append(pa.array(before))
                sums[c] = before[-1] + v[-1]
            key, place = g[-1], places[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)

    kinds = df.schema
    names = [*df.columns, "place", *values.values()]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "place bigint", *(f"`{n}` {kinds[c].dataType.simpleString()}" for c, n in values.items())])
    rows = df.withColumn("_read", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(group, *order, "_read").sortWithinPartitions(group, *order, "_read").drop("_read")
    placed = stable(placed.mapInArrow(add, schema).withColumn("_pid", F.spark_partition_id()))
    runs = placed.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_place"), *[F.sum(c).alias(f"_{n}") for c, n in values.items()])
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = ["place", *values.values()]
    bases = runs.select(group, "_pid", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    joined = placed.join(bases, [group, "_pid"])
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])
