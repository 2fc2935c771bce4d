"""Joins and positions that stay balanced when one key holds a large share of the rows."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedyard.session import kept, stable

# Keys above this many rows take the broadcast branch, of more than HOT_KEYS such keys the largest.
# A key that is not among these has less than a HOT_KEYS-th of all rows, so that no key is both hot and left out.
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000
SPREAD = 4096
# Up to this many counted runs are broadcast.
BROADCAST_RUNS = 50_000


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], row_count: str,
                hot_rows: int = HOT_ROWS, spread_by: Column | None = None) -> DataFrame:
    """Left join to ``lookup`` (one row per key) without sending a hot key's facts to one task.

    ``row_count`` names the lookup column that holds the number of facts per key. Lookup rows of hot
    keys are broadcast, HOT_KEYS at most; facts matched there, and facts without a key, carry a salt that
    spreads them over the shuffle join of all other keys, where they match nothing.
    """
    values = [c for c in lookup.columns if c not in keys and c != row_count]
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    lookup = lookup.filter(~keyless)
    largest = lookup.filter(F.col(row_count) > hot_rows).orderBy(F.desc(row_count), *keys).limit(HOT_KEYS)
    hot = largest.select(*keys, F.struct(F.lit(1).alias("_hit"), *values).alias("_hot"))
    salt = F.pmod(F.xxhash64(spread_by if spread_by is not None else F.struct(*facts.columns)), F.lit(SPREAD))
    marked = facts.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | keyless, salt + 1).otherwise(F.lit(0).cast("bigint"))
    )
    # both branches read the same columns, so the exchange below an aggregated lookup is reused; facts of hot keys do not match here
    cold = lookup.filter(F.col(row_count) >= 0).select(*keys, F.lit(0).cast("bigint").alias("_salt"),
                         F.struct(F.lit(1).alias("_hit"), *values).alias("_cold"))
    joined = marked.join(cold, [*keys, "_salt"], "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.withColumn("_found", found).select(
        *facts.columns, *[F.col("_found").getField(v).alias(v) for v in values]
    )


def with_position(df: DataFrame, group: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row within its group, whatever the size of the group.

    Rows are range-partitioned and sorted by group and order, so a large group spans many tasks.
    Each (group, partition) run gets its base from a running sum over runs, of which a group has at
    most one per partition. The sorted rows are written, so both passes see the same placement.
    Group columns must not be NULL.
    """
    keys = [F.col(g) for g in group]
    placed = kept(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    )
    runs = stable(placed.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_len"), F.min("_mid").alias("_first")))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.withColumn("_base", F.coalesce(F.sum("_len").over(before), F.lit(0)) - F.col("_first")).drop("_len", "_first")
    # a run per group and partition: where they are few, the rows stay where they are
    bases = F.broadcast(bases) if runs.count() <= BROADCAST_RUNS else bases
    return (
        placed.join(bases, [*group, "_pid"])
        .withColumn(name, F.col("_base") + F.col("_mid"))
        .drop("_pid", "_mid", "_base")
    )
