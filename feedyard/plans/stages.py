"""Manifest, finalize, configuration sync and dispatch, each with its log rows."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from feedyard.operators import config_sync, dispatch, inventory, logs
from feedyard.session import kept, stable


@dataclass
class Stage:
    table: DataFrame
    summary: DataFrame
    job_log: DataFrame
    file_log: DataFrame | None = None
    notifications: DataFrame | None = None


def run_manifest(known: DataFrame, flags: DataFrame, parsed: DataFrame, now, run_id: str | None = None) -> Stage:
    """Record every eligible file, also those beyond this run's batches, as discovered.

    Requests that only discover record nothing; of several requests for a file the first by id has it.
    """
    wanted = flags.filter("final_eligible")
    if "request_type" in flags.columns:
        wanted = wanted.filter("request_type <> 'DISCOVERY'")
    first = wanted.groupBy("feed_key", "file_path").agg(F.min("request_id").alias("request_id"))
    wanted = wanted.join(first, ["feed_key", "file_path", "request_id"], "left_semi")
    rows = kept(inventory.manifest_rows(wanted, parsed, now).withColumn("dispatch_run_id", F.lit(run_id).cast("string")))
    merged = inventory.merge_inventory(known, rows)
    found = rows.groupBy("feed_key", "request_id").agg(F.count(F.lit(1)).alias("n"))
    return Stage(
        merged, inventory.manifest_summary(merged),
        logs.job_log(found, now, task_name="manifest", task_status="SUCCEEDED", dispatch_run_id=run_id,
                     status_reason=F.concat(F.lit("discovered_file_count="), "n")),
        logs.file_log(rows, now, stage_name="DISCOVERY", stage_status="SUCCEEDED", status_reason=F.col("parse_status"), cnt_row_written=None))


def run_finalize(known: DataFrame, now, run_id: str | None = None) -> Stage:
    """Adjudicate, count and log every file's verdict.

    Only the verdicts are kept, one narrow row per winner; each output meets the inventory with the columns that it needs.
    """
    decided = inventory.decide(known, kept(inventory.verdicts(known)))
    summary = inventory.finalize_summary(decided)
    return Stage(
        decided, summary,
        logs.job_log(summary, now, task_name="finalize", task_status="SUCCEEDED", dispatch_run_id=run_id,
                     status_reason=F.concat(F.lit("ready_for_silver_count="), "ready_for_silver_count")),
        logs.file_log(decided, now, stage_name="ADJUDICATION", stage_status=F.col("promote_status"), cnt_row_written=F.col("cnt_row_bronze"), dispatch_run_id=run_id))


def run_config_sync(raw: DataFrame, existing: DataFrame | None, root: str, now, run_id: str, require_src_uri: bool = False,
                    env: str = "dev", override_recipients: str | None = None) -> Stage:
    """Configuration files into the configuration table.

    Without a table yet the files make it; later only unseen keys are added and known ones synced.
    """
    rows = stable(config_sync.fill_defaults(raw))
    if require_src_uri:
        bad = config_sync.policy_violations(rows, env, True).select("violation").first()
        if bad:
            raise ValueError(bad["violation"])
    incoming = config_sync.with_source_dir(config_sync.deduplicate(rows), root).withColumn("dispatch_run_id", F.lit(run_id))
    lost = stable(config_sync.dropped(rows))
    if rows.isEmpty():
        empty = rows.sparkSession.range(1).select(F.lit("dispatcher").alias("feed_key"))
        note = logs.notifications(empty.withColumn("resolved_recipients", logs.recipients(F.lit(None).cast("string"), override_recipients)), now, severity="WARNING", category="CONFIG",
                                  event_type="EMPTY_CONFIG", message="No config rows found", feed_key=None, dispatch_run_id=run_id)
        return Stage(existing if existing is not None else incoming, empty,
                     logs.job_log(empty, now, task_name="dispatcher", task_status="SUCCEEDED", status_reason="no config rows", dispatch_run_id=run_id), notifications=note)
    if existing is None:
        table, added = incoming, incoming
    else:
        added = config_sync.new_keys(incoming, existing)
        table = config_sync.merge_config(existing, incoming).unionByName(added.select(*existing.columns))
    told = lost.join(config_sync.deduplicate(rows).select("feed_key", "feed_sub_key", "notify_recipients"), ["feed_key", "feed_sub_key"], "left").withColumns({
        "message": F.concat(F.lit("Duplicate config resolved: "), F.concat_ws("|", "feed_key", "feed_sub_key"), F.lit(", winner from "), "winner_from"),
        "details": F.struct("feed_key", "feed_sub_key", "dropped_from", "winner_from", "reason"),
        "resolved_recipients": logs.recipients(F.col("notify_recipients"), override_recipients)})
    warned = logs.job_log(lost, now, task_name="dispatcher_dedup", task_status="WARNING", dispatch_run_id=run_id, status_reason=F.concat(
        F.lit("duplicate "), F.concat_ws("|", "feed_key", "feed_sub_key"), F.lit(": dropped from "), "dropped_from", F.lit(", winner from "), "winner_from", F.lit("; "), "reason"))
    return Stage(table, added.select("feed_key", "feed_sub_key"), warned,
                 notifications=logs.notifications(told, now, severity="WARNING", category="CONFIG", event_type="DUPLICATE_CONFIG_RESOLVED", dispatch_run_id=run_id))


def run_dispatch(config: DataFrame, state: DataFrame, active_runs: DataFrame, now, run_id: str, honor_auto_trigger: bool = True,
                 honor_hold: bool = True) -> Stage:
    """Decide which feeds start now; the state follows from the decisions as recorded."""
    planned = stable(dispatch.plan(dispatch.gates(config, state, now, honor_auto_trigger, honor_hold), active_runs))
    started = F.col("decision") == "TRIGGER"
    return Stage(
        dispatch.merge_state(state, planned, now, run_id), planned,
        logs.job_log(planned, now, task_name="dispatcher_trigger", task_status=F.when(started, "SUCCEEDED").otherwise("SKIPPED"),
                     status_reason=F.coalesce("reason", F.lit("due")), dispatch_run_id=run_id, request_id=None))
