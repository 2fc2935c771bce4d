"""Keyed upsert, update and delete as snapshot-producing joins."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from feedyard.functions.fingerprints import packed, unpacked
from feedyard.functions.text import col_q
from feedyard.session import stable


# A source of at most this many counted rows is broadcast.
BROADCAST_ROWS = 50_000


def unique_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """Fail when two source rows share a key, as a merge does."""
    others = [c for c in source.columns if c not in keys]
    # keys are nearly always unique, so rows are not gathered before the shuffle
    one = source.repartition(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(col_q(c)).alias(c) for c in others])
    fails = F.raise_error(F.lit(f"several source rows for one key of {keys}")).cast("boolean")
    return one.filter(F.when(F.col("_n") == 1, True).otherwise(fails)).drop("_n")


def src(name: str) -> Column:
    """Source column inside a matched clause."""
    return F.col("_src").getField(name)


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           matched: list[tuple[Column, dict[str, Column]]] | None = None,
           insert: bool = True) -> DataFrame:
    """New snapshot of ``target`` after merging ``source``.

    ``matched`` holds clauses in order; the first whose condition is true sets its columns.
    Conditions and values see target columns by name and source columns through :func:`src`.
    With ``insert`` unmatched source rows are appended, absent columns as NULL.

    A source of at most ``BROADCAST_ROWS`` counted rows is checkpointed and broadcast, so the target is not shuffled:
    unmatched rows are found by narrowing the target to its matched keys first. With a larger source both sides are
    shuffled once by the keys and meet in one join, the keys packed; only columns that are asked for travel.
    """
    payload = [c for c in source.columns if c not in keys]
    small = source.select(*[col_q(k) for k in keys]).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = [k for k in keys if source.schema[k].dataType == target.schema[k].dataType == StringType()]
    if not small and texts:
        source = source.withColumns({k: packed(col_q(k), b"\x03") for k in texts})
    checked = unique_source(source, keys) if payload else source.distinct()
    checked = stable(checked) if small else checked
    # source columns travel one by one under names of their own, so those that no clause reads are left out
    named = {c: f"_src_{i}" for i, c in enumerate(source.columns)}
    flat = checked.select(*[col_q(c).alias(n) for c, n in named.items()], F.lit(1).alias("_src_hit"))
    ours = target if small else target.withColumns({k: packed(col_q(k)) for k in texts})
    on = reduce(lambda a, b: a & b, [ours[f"`{k}`"] == flat[named[k]] for k in keys])
    if small:
        both = ours.join(F.broadcast(flat), on, "left")
    else:
        both = ours.withColumn("_was", F.lit(1)).join(flat, on, "full_outer" if insert else "left")
        back = {**{k: unpacked(col_q(k)) for k in texts}, **{named[k]: unpacked(F.col(named[k])) for k in texts}}
        both = both.withColumns(back) if texts else both
    both = both.withColumn("_src", F.struct(*[F.col(n).alias(c) for c, n in named.items()]))
    hit = F.col("_src_hit").isNotNull()
    cells = []
    for name in target.columns:
        value = col_q(name)
        for condition, sets in reversed(matched or []):
            value = F.when(hit & F.coalesce(condition, F.lit(False)), sets[name] if name in sets else col_q(name)).otherwise(value)
        if insert and not small:
            value = F.when(F.col("_was").isNull(), src(name) if name in named else F.lit(None)).otherwise(value)
        cells.append(value.cast(target.schema[name].dataType).alias(name))
    updated = both.select(*cells)
    if not insert or not small:
        return updated
    wanted = checked.select(*[col_q(k) for k in keys])
    seen = target.select(*[col_q(k) for k in keys]).join(F.broadcast(wanted), keys, "left_semi").distinct()
    added = checked.join(seen, keys, "left_anti")
    return updated.unionByName(added.select(
        [(col_q(c) if c in added.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    ))


def update_where(df: DataFrame, condition: Column, sets: dict[str, Column]) -> DataFrame:
    on = F.coalesce(condition, F.lit(False))
    return df.select([
        F.when(on, sets[c]).otherwise(col_q(c)).cast(df.schema[c].dataType).alias(c) if c in sets else col_q(c)
        for c in df.columns
    ])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(~F.coalesce(condition, F.lit(False)))
