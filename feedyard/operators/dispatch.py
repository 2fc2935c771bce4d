"""Which feeds to start now."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedyard.functions.text import parse_utc, yes
from feedyard.operators.schedule import is_due, next_fire, parse_expressions, split_expressions
from feedyard.operators.upsert import src, update_where, upsert

# Decisions and their reasons.
REASON_NOT_ELIGIBLE = "row not eligible"
REASON_ACTIVE_RUN = "active ingestion run already exists for feed_key="


def gates(config: DataFrame, state: DataFrame, now, honor_auto_trigger: bool = True, honor_hold: bool = True) -> DataFrame:
    """One row per feed with each gate as its own flag and ``eligible`` as their conjunction."""
    at = F.lit(now).cast("timestamp")
    keyed = config.withColumn("feed_sub_key", F.coalesce("feed_sub_key", F.lit("DEFAULT")))
    last = state.select("feed_key", F.coalesce("feed_sub_key", F.lit("DEFAULT")).alias("feed_sub_key"), "last_dispatched_at")
    rows = keyed.join(last, ["feed_key", "feed_sub_key"], "left")
    rows = next_fire(rows, "sched_cron", "sched_timezone", "last_dispatched_at", "next_after_last")
    hold = parse_utc(F.col("ctl_maintenance_hold_until"))
    return rows.withColumns({
        "gate_active": yes(F.col("ctl_active")),
        "gate_auto": yes(F.col("ctl_auto_trigger")) if honor_auto_trigger else F.lit(True),
        "gate_hold": F.coalesce(at >= hold, F.lit(True)) if honor_hold else F.lit(True),
        "gate_due": is_due(F.col("sched_cron"), F.col("last_dispatched_at"), F.col("next_after_last"), at),
    }).withColumn("eligible", F.expr("gate_active AND gate_auto AND gate_hold AND gate_due")).join(_valid_schedules(config), "sched_cron", "left").withColumn("cron_valid", F.coalesce("cron_valid", F.lit(False)))


def _valid_schedules(config: DataFrame) -> DataFrame:
    """Each distinct schedule text, and whether one of its expressions can be read."""
    each = config.select("sched_cron").distinct().withColumn("expr", F.explode(split_expressions(F.col("sched_cron"))))
    return parse_expressions(each).groupBy("sched_cron").agg(F.max("cron_valid").alias("cron_valid"))


def plan(gated: DataFrame, active_runs: DataFrame) -> DataFrame:
    """One decision per feed: start it, or skip it with a reason."""
    running = active_runs.select("feed_key").distinct().withColumn("_running", F.lit(True))
    rows = gated.join(running, "feed_key", "left")
    busy = F.col("eligible") & F.coalesce("_running", F.lit(False))
    return rows.withColumns({
        "decision": F.when(F.col("eligible") & ~busy, "TRIGGER").otherwise("SKIPPED"),
        "reason": F.when(~F.col("eligible"), REASON_NOT_ELIGIBLE).when(busy, F.concat(F.lit(REASON_ACTIVE_RUN), "feed_key")),
    }).drop("_running")


def merge_state(state: DataFrame, planned: DataFrame, now, run_id: str) -> DataFrame:
    """New dispatch state after the started feeds, with their next fire in the feed's own zone."""
    started = planned.filter(F.col("decision") == "TRIGGER").select("feed_key", "feed_sub_key", "sched_cron", "sched_timezone").withColumn(
        "_now", F.lit(now).cast("timestamp"))
    source = next_fire(started, "sched_cron", "sched_timezone", "_now", "next_dispatched_at").select(
        "feed_key", "feed_sub_key", F.col("_now").alias("last_dispatched_at"), "next_dispatched_at", F.lit(run_id).alias("dispatch_run_id"))
    sets = {c: src(c) for c in ("last_dispatched_at", "next_dispatched_at", "dispatch_run_id")}
    return upsert(state, source, ["feed_key", "feed_sub_key"], [(F.lit(True), sets)])


def reset_state(state: DataFrame, feed_key: str) -> DataFrame:
    none = F.lit(None).cast("timestamp")
    return update_where(state, F.col("feed_key") == feed_key, {"last_dispatched_at": none, "next_dispatched_at": none})


def never_dispatched(config: DataFrame, state: DataFrame) -> DataFrame:
    return config.filter(yes(F.col("ctl_active"))).join(
        state.filter(F.col("last_dispatched_at").isNotNull()).select("feed_key", "feed_sub_key"), ["feed_key", "feed_sub_key"], "left_anti")


def overdue(state: DataFrame, now) -> DataFrame:
    at = F.lit(now).cast("timestamp")
    late = (F.unix_timestamp(at) - F.unix_timestamp("next_dispatched_at")) / 60
    return state.filter(F.col("next_dispatched_at") < at).withColumn("minutes_overdue", F.floor(late).cast("bigint"))
