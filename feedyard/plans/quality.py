"""Data quality as a stage of a load: rules, verdict per file, kept rows, quarantine, violations, results and notices of one commit."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from feedyard import schemas
from feedyard.functions.text import col_q
from feedyard.operators import commits, logs, quality as q
from feedyard.session import stable

NOT_EVALUATED = "NOT_EVALUATED"
CYCLE_EVENT = "DQ_DEPENDENCY_CYCLE"
REASON_FAILED = "data quality failed"
DISPOSITIONS = ("KEPT", "DROPPED", "QUARANTINED", "ABORTED")
ROW_NUMBER = "src_row_number"


@dataclass
class Quality:
    """What the rules of a feed make of one load. ``counts`` is filled by the pass that writes the kept rows."""
    rules: list[q.Rule]
    disposed: DataFrame
    state: DataFrame
    seen: Observation

    @property
    def kept(self) -> DataFrame:
        """Rows to load, as they came; while they are written, the rows of every disposition are counted."""
        watched = self.disposed.observe(self.seen, *[F.count_if(F.col("disposition") == d).alias(d) for d in DISPOSITIONS])
        return q.kept(watched, self.rules).drop(*q.FILE, "file_name", ROW_NUMBER)

    @property
    def counts(self) -> dict[str, int]:
        return self.seen.get

    @property
    def status(self) -> DataFrame:
        return q.file_status(self.state, self.rules)


def run_quality(rules_table: DataFrame | None, feed_key: str, rows: DataFrame, today: str) -> Quality | None:
    """The verdict over bronze rows that carry ``src_row_number``; None, without touching a row, for a feed that has no active rules.

    One pass reduces the rows to counts per file and failure pattern, on which tiers, thresholds and dependencies are settled.
    """
    rules = q.active_rules(rules_table, feed_key) if rules_table is not None else []
    if not rules:
        return None
    named = rows.withColumns({"file_fingerprint": F.col("src_file_fingerprint"), "file_name": F.col("src_file_name")})
    masked = q.with_mask(named, rules, today)
    state = q.decide(masked, rules)
    return Quality(rules, q.dispose(masked, state, rules), state, Observation())


def write_quality(stage: Quality, files: DataFrame, feed_key: str, quarantine: str, log_dir: str, load_id: str, at: Column,
                  request_id: str | None, run_id: str | None) -> DataFrame:
    """Write quarantine, violations and results as parts of the load, after the kept rows; returns its notification rows.

    The rows are read once more only if that pass met rows to quarantine, and then only for the files that have some.
    """
    ids = {"feed_key": F.lit(feed_key), "request_id": F.lit(request_id).cast("string"), "dispatch_run_id": F.lit(run_id).cast("string")}
    known = files.select("file_fingerprint", "file_name")
    result = stable(q.results(stage.state, stage.rules).join(known, "file_fingerprint").withColumns(ids))
    logs.append_log(logs.shape(result, schemas.DQ_RESULTS, ts_evaluated=at), f"{log_dir}/dq_results", load_id)
    if stage.counts["QUARANTINED"]:
        bad = result.filter("outcome = 'QUARANTINED'").select("file_fingerprint").distinct()
        held = stable(stage.disposed.filter("disposition = 'QUARANTINED'").join(bad, "file_fingerprint", "left_semi"))
        own = [c for c in q.quarantined(held, stage.rules).columns if c not in (*schemas.names(schemas.BRONZE_TECHNICAL), *q.FILE, "file_name", "quarantine_id", ROW_NUMBER, "_rows")]
        commits.write_part(q.quarantined(held, stage.rules).select(
            "quarantine_id", ROW_NUMBER, *map(col_q, own), "feed_key", "file_name", "file_fingerprint", "request_id", "dispatch_run_id",
            at.alias("ts_quarantined")), quarantine, load_id)
        found = q.violations(held, stage.rules).join(known, "file_fingerprint").withColumns({"feed_key": F.lit(feed_key), "ts_evaluated": at})
        commits.write_part(found.select(*schemas.names(schemas.DQ_VIOLATIONS)), f"{log_dir}/dq_violations", load_id)
    return _notices(result, stage, ids, at)


def _notices(result: DataFrame, stage: Quality, ids: dict[str, Column], at: Column) -> DataFrame:
    """Notification rows: one per file and rule that did not pass, and one for rules that wait for each other."""
    told = q.dq_notifications(result).join(result.select("file_fingerprint", "rule_name", "file_name", "cnt_fail", "cnt_total"), ["file_fingerprint", "rule_name"])
    told = told.withColumns({**ids, "details": F.struct("file_name", "rule_name", "cnt_fail", "cnt_total")})
    out = logs.notifications(told, at)
    cyclic = sorted(q.in_order(stage.rules)[1])
    if cyclic:
        one = result.sparkSession.range(1).withColumns({**ids, "message": F.lit("Rules wait for each other: " + ", ".join(cyclic)), "details": F.struct(F.lit(",".join(cyclic)).alias("rules"))})
        out = out.unionByName(logs.notifications(one, at, severity="ERROR", category="CONFIG", event_type=CYCLE_EVENT))
    return out


def judged(results: DataFrame, stage: Quality | None) -> DataFrame:
    """The files of a load with their ``dq_status``; one that failed its rules has not succeeded, and says by which rule.

    A file without rows, or of a feed without rules, is not evaluated.
    """
    if stage is None:
        return results.withColumn("dq_status", F.lit(NOT_EVALUATED))
    first = q.results(stage.state, stage.rules).filter("outcome = 'FAILED'").groupBy("file_fingerprint").agg(
        F.min(F.struct("rule_tier", "rule_name")).alias("_by"))
    rows = results.join(stage.status, "file_fingerprint", "left").join(first, "file_fingerprint", "left")
    failed = F.col("dq_status") == "FAILED"
    return rows.withColumns({
        "dq_status": F.coalesce("dq_status", F.lit(NOT_EVALUATED)),
        "error": F.when(failed, F.concat(F.lit(f"{REASON_FAILED}: "), "_by.rule_name")).otherwise(F.col("error"))}).drop("_by")
