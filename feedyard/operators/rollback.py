"""Undoing a run, and removing or renaming a feed."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedyard.functions.paths import fingerprint_path
from feedyard.operators.upsert import delete_where, update_where

# The log tables a rollback covers.
LOG_TABLES = ("job_log", "file_log", "request_log", "discovery_log", "schema_change_log")


def scope(feed_key: str, run_id: str | None = None, request_id: str | None = None) -> Column:
    """Rows of a feed, narrowed to a run and a request where those are given."""
    wanted = {"feed_key": feed_key, "dispatch_run_id": (run_id or "").strip(), "request_id": (request_id or "").strip()}
    return reduce(lambda a, b: a & b, [F.col(c) == value for c, value in wanted.items() if value])


def touched_paths(file_log: DataFrame, feed_key: str, run_id: str | None = None, request_id: str | None = None) -> DataFrame:
    """Normalised paths of the files the scope touched."""
    return file_log.filter(scope(feed_key, run_id, request_id) & F.col("file_path").isNotNull()).select(
        fingerprint_path(F.col("file_path")).alias("_path")).distinct()


def plan(tables: dict[str, DataFrame], feed_key: str, run_id: str | None = None, request_id: str | None = None) -> DataFrame:
    """How many rows of each table a rollback would delete; nothing is deleted.

    ``tables`` holds the logs by name, ``inventory`` and optionally ``bronze``.
    """
    counted = []

    def add(name: str, df: DataFrame) -> None:
        counted.append(df.agg(F.count(F.lit(1)).alias("cnt_rows")).select(F.lit(name).alias("table_name"), "cnt_rows"))

    for name in LOG_TABLES:
        if name in tables:
            add(name, tables[name].filter(scope(feed_key, run_id, request_id)))
    add("inventory", tables["inventory"].filter(scope(feed_key, run_id, request_id)))
    paths = touched_paths(tables["file_log"], feed_key, run_id, request_id)
    add("candidate_file_paths", paths)
    if "bronze" in tables:
        add("bronze", _of_paths(tables["bronze"].filter(F.col("feed_key") == feed_key), paths, "left_semi"))
    return reduce(lambda a, b: a.unionByName(b), counted)


def _of_paths(bronze: DataFrame, paths: DataFrame, how: str) -> DataFrame:
    return bronze.withColumn("_path", fingerprint_path(F.col("src_file_path"))).join(paths, "_path", how).drop("_path")


def apply(tables: dict[str, DataFrame], feed_key: str, run_id: str | None = None, request_id: str | None = None,
          purge_config: bool = False) -> dict[str, DataFrame]:
    """The tables after the rollback, as new snapshots."""
    out = {n: delete_where(tables[n], scope(feed_key, run_id, request_id)) for n in LOG_TABLES if n in tables}
    out["inventory"] = delete_where(tables["inventory"], scope(feed_key, run_id, request_id))
    if "bronze" in tables:
        mine, paths = F.col("feed_key").eqNullSafe(feed_key), touched_paths(tables["file_log"], feed_key, run_id, request_id)
        out["bronze"] = tables["bronze"].filter(~mine).unionByName(_of_paths(tables["bronze"].filter(mine), paths, "left_anti"))
    if "config" in tables:
        out["config"] = delete_where(tables["config"], F.lit(purge_config) & (F.col("feed_key") == feed_key))
    return out


def purge_feed(tables: dict[str, DataFrame], feed_key: str) -> dict[str, DataFrame]:
    """Every table without the feed."""
    return {n: delete_where(df, F.col("feed_key") == feed_key) for n, df in tables.items()}


def rename_feed(tables: dict[str, DataFrame], old: str, new: str) -> dict[str, DataFrame]:
    """Every table with the feed under its new key; group keys in the inventory start with it and follow."""
    out = {}
    for name, df in tables.items():
        sets = {"feed_key": F.lit(new)}
        for c in ("delivery_group_key", "part_group_key"):
            if c in df.columns:
                sets[c] = F.concat(F.lit(new), F.substr(F.col(c), F.lit(len(old) + 1)))
        out[name] = update_where(df, F.col("feed_key") == old, sets)
    return out
