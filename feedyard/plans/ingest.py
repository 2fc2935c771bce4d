"""Loading one run's files of a feed into its bronze table."""
from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedyard.functions.filenames import parse_filename
from feedyard.functions.fingerprints import file_fingerprint
from feedyard.functions.paths import base_name
from feedyard.functions.text import blank_to_null, col_q
from feedyard.operators import bronze, commits, drift, logs
from feedyard.plans.quality import Quality, judged, run_quality, write_quality
from feedyard.session import stable, work_dir
from feedyard.sources import archives, delimited
from feedyard.sources.listing import is_hidden


class LoadFailed(RuntimeError):
    """No file of a load could be read."""


@dataclass
class Feed:
    """What ingest needs to know of a feed."""
    feed_key: str
    regex: str
    capture_spec: str
    delimiter: str = "|"
    has_header: bool = True
    recipients: str | None = None


@dataclass
class Batch:
    """The rows of one load with the state of its files."""
    rows: DataFrame
    files: DataFrame
    heads: DataFrame


@dataclass
class Report:
    """What to log about a load."""
    results: DataFrame
    file_log: DataFrame
    schema_changes: DataFrame
    notifications: DataFrame


def ingest_fingerprints(refs: DataFrame, listing: DataFrame) -> DataFrame:
    """Fingerprint per reference: the batch's own, else that of the listing, else of the path alone."""
    listed = listing.select("file_path", F.col("file_fingerprint").alias("_listed"), F.col("file_name").alias("_name")).dropDuplicates(["file_path"])
    rows = refs.join(listed, "file_path", "left")
    path_only = file_fingerprint(F.col("file_path"), F.lit(None), F.lit(None))
    return rows.withColumns({
        "file_fingerprint": F.coalesce(blank_to_null(F.col("fingerprint")), "_listed", path_only),
        "file_name": F.coalesce("_name", base_name(F.col("file_path"))),
    }).drop("_listed", "_name", "fingerprint")


def _groups(heads: DataFrame, keys: list[str]) -> list:
    """Distinct headers with their files. Only the file references of one run pass here, never data."""
    return heads.groupBy(*keys).agg(F.collect_list("file_path").alias("paths")).collect()


def _plain_rows(spark: SparkSession, heads: DataFrame, feed: Feed) -> list[DataFrame]:
    """One scan per header; files with names that Spark's sources leave out are read by tasks that open them."""
    keys = ["columns"] if feed.has_header else ["width"]
    hidden = heads.filter(is_hidden(base_name(F.col("file_path"))))
    parts = []
    for g in _groups(heads.filter(~is_hidden(base_name(F.col("file_path")))), keys):
        parts.append(delimited.scan_delimited(spark, list(g["paths"]), feed.delimiter, feed.has_header,
                                              list(g["columns"]) if feed.has_header else None, None if feed.has_header else g["width"]))
    for g in hidden.select(*keys).distinct().collect():
        columns, width = (list(g["columns"]), None) if feed.has_header else (None, g["width"])
        same = F.col("columns") == F.array(*map(F.lit, columns)).cast("array<string>") if feed.has_header else F.col("width") == width
        parts.append(delimited.scan_hidden(hidden.filter(same), feed.delimiter, feed.has_header, columns, width))
    return parts


def _zip_lines(spark: SparkSession, members: DataFrame) -> DataFrame:
    """The lines of all members as a table of the shared folder, so that each archive is unpacked once, whatever is asked of it."""
    path = work_dir(spark, "members")
    archives.scan_members(members).write.parquet(path)
    return spark.read.parquet(path)


def _zip_rows(lines: DataFrame, members: DataFrame, feed: Feed) -> list[DataFrame]:
    """Rows of archive members, by name per member, since members may have different headers."""
    heads = members.filter("columns IS NOT NULL")
    out = []
    for g in heads.groupBy("columns", "width").agg(F.count(F.lit(1)).alias("n")).collect():
        names = delimited.final_names(list(g["columns"])) if feed.has_header else [f"_c{i}" for i in range(g["width"])]
        same = heads.filter(F.col("columns") == F.array(*[F.lit(c) for c in g["columns"]]) if feed.has_header else F.col("width") == g["width"])
        body = lines.join(same.select("file_path", "member"), ["file_path", "member"], "left_semi")
        if feed.has_header:
            body = body.filter(F.col("line_no") > 1)
        ddl = ", ".join(f"c{i} string" for i in range(len(names)))
        cells = F.from_csv("line", F.lit(ddl), {"sep": feed.delimiter})
        body = body.filter(F.trim("line") != "").withColumn("_v", cells)
        out.append(body.select(*[F.col(f"_v.c{i}").alias(n) for i, n in enumerate(names) if n is not None], F.col("file_path").alias("_file_path"),
                               F.xxhash64("member").alias("_block_start"), F.col("line_no").alias("_row_id")))
    return out


def _unite(parts: list[DataFrame]) -> DataFrame:
    """Rows of all headers as text by name; names that differ only in case are one column, the first spelling wins."""
    spelled: dict[str, str] = {}
    columns: list[str] = []
    for p in parts:
        for c in p.columns:
            if c not in delimited.META and c.lower() not in spelled:
                spelled[c.lower()] = c
                columns.append(c)
    fixed = [p.select(*[col_q(c).alias(spelled.get(c.lower(), c)) for c in p.columns]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), [delimited.align(p, columns) for p in fixed])


def read_batch(spark: SparkSession, feed: Feed, refs: DataFrame, batch_id: str, request_id: str | None, run_id: str | None, now, numbered: bool = False) -> Batch:
    """Read the files of ``refs`` (``file_path, file_name, file_fingerprint``); with ``numbered`` the rows carry ``src_row_number``.

    One scan per distinct header rather than per file. A file that cannot be opened, or an archive without text, encrypted or
    damaged in any member, fails on its own and the others go on; when all fail, so does the load.
    """
    files = stable(parse_filename(refs.withColumn("feed_key", F.lit(feed.feed_key)), feed.regex, feed.capture_spec))
    zipped = files.filter("file_extension = 'zip'").select("file_path")
    plain = files.filter("file_extension IS NULL OR file_extension <> 'zip'").select("file_path")
    heads = delimited.read_headers(plain, feed.delimiter, feed.has_header)
    names = delimited.split_header(F.col("first_line"), feed.delimiter)
    members = stable(archives.list_members(zipped).withColumns({"columns": names, "width": F.size(names)}))
    lines = None
    if not members.filter("member IS NOT NULL").isEmpty():
        # an archive of which any member breaks off fails as a whole, by itself
        lines = _zip_lines(spark, members.filter("member IS NOT NULL"))
        broken = lines.filter("error IS NOT NULL").groupBy("file_path").agg(F.min("error").alias("broken"))
        members = stable(members.join(broken, "file_path", "left").withColumn("error", F.coalesce("error", "broken")).drop("broken"))
    # the header of an archive is that of its first member
    zip_heads = members.groupBy("file_path").agg(
        F.min_by("first_line", "member").alias("first_line"), F.max("error").alias("error"), F.min_by("columns", "member").alias("columns"),
        F.min_by("width", "member").alias("width"), F.count("member").alias("members"))
    heads = stable(heads.withColumn("members", F.lit(0).cast("bigint")).unionByName(zip_heads))
    sound = heads.filter("error IS NULL")
    parts = _plain_rows(spark, sound.filter("members = 0"), feed)
    if lines is not None:
        parts += _zip_rows(lines, members.filter("member IS NOT NULL AND error IS NULL"), feed)
    if not parts:
        failed = heads.select("error").first()
        raise LoadFailed(f"All file(s) in batch {batch_id} failed: {failed['error'] if failed else 'no files'}")
    united = _unite(parts)
    if numbered:
        united = delimited.number_lines(united, feed.has_header)
    rows = bronze.add_lineage(united, files, feed.feed_key, request_id, run_id, now, also=("src_row_number",) if numbered else ())
    return Batch(rows, files, heads)


def report(feed: Feed, batch: Batch, counts: DataFrame, target_columns: list[str], target_table: str, batch_id: str,
           request_id: str | None, run_id: str | None, now, checked: Quality | None = None) -> Report:
    """Log rows of the end of a load, from the rows counted per fingerprint once they are written; ``now`` is when it ended.

    A file that failed the rules of ``checked`` has not succeeded, though it could be read.
    """
    outcome = judged(batch.files.join(batch.heads.select("file_path", "error", "columns", "members"), "file_path"), checked)
    counts = counts.withColumnRenamed("src_file_fingerprint", "file_fingerprint")
    ids = {"request_id": F.lit(request_id).cast("string"), "dispatch_run_id": F.lit(run_id).cast("string")}
    done = outcome.join(counts, "file_fingerprint", "left").withColumns({
        "succeeded": F.col("error").isNull(), "cnt_row_written": F.when(F.col("error").isNull(), F.coalesce("cnt_row_bronze", F.lit(0))), **ids})
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    tag = F.lit(f"batch_id={batch_id}; ")
    ended = F.when(F.col("succeeded"), F.concat(tag, F.lit("ingest completed"))).otherwise(F.concat(tag, F.lit("ingest failed: "), F.col("error")))

    def step(when, stage, status, reason, count):
        return F.when(when, F.struct(F.lit(stage).alias("stage_name"), status.alias("stage_status"), reason.alias("status_reason"), count.alias("cnt")))

    steps = F.array_compact(F.array(
        step(F.col("succeeded") & (F.col("members") > 0), "ZIP_EXTRACT", F.lit("SUCCEEDED"), F.lit("zip members read"), F.col("members")),
        step(F.lit(True), "INGEST_CONTROL", F.when(F.col("succeeded"), "SUCCEEDED").otherwise("FAILED"), ended, F.col("cnt_row_written")),
        step(F.col("succeeded"), "BRONZE_LOAD", F.lit("SUCCEEDED"), F.lit("bronze load succeeded"), F.col("cnt_row_written"))))
    events = done.withColumn("step", F.explode(steps)).withColumns({
        "stage_name": F.col("step.stage_name"), "stage_status": F.col("step.stage_status"), "status_reason": F.col("step.status_reason"),
        "cnt_row_written": F.col("step.cnt")})
    target = F.array(*[F.lit(c) for c in target_columns]).cast("array<string>")
    changes = drift.detect_drift(outcome.filter("error IS NULL").withColumns({"source_columns": F.col("columns"), "target_columns": target, **ids}),
                                 has_header=feed.has_header)
    return Report(done.withColumn("batch_id", F.lit(batch_id)), logs.file_log(events, at), logs.schema_change_log(changes, at, target_table=target_table),
                  drift_notifications(changes, feed, target_table, now))


def drift_notifications(changes: DataFrame, feed: Feed, target_table: str, now) -> DataFrame:
    """One warning per file whose columns differ from the target."""
    drifted = changes.filter("change_detected = 'Y'").withColumns({
        "details": F.struct("file_name", "missing_in_file", "new_in_file", F.lit(target_table).alias("bronze_table")),
        "message": F.concat(F.lit("Schema drift in "), "file_name", F.lit(f" vs {target_table}: "), "status_reason"),
        "resolved_recipients": logs.recipients(F.lit(feed.recipients).cast("string"), None)})
    return logs.notifications(drifted, now, severity="WARNING", category="SCHEMA", event_type="SCHEMA_DRIFT_DETECTED")


def start_log(feed: Feed, refs: DataFrame, batch_id: str, request_id: str | None, run_id: str | None, now,
              status: str = "STARTED", reason: str = "ingest started") -> DataFrame:
    """One control row per file of a load, which says that it began (or, with another status, how all of it ended)."""
    files = parse_filename(refs.withColumn("feed_key", F.lit(feed.feed_key)), feed.regex, feed.capture_spec)
    return logs.file_log(files.withColumns({"request_id": F.lit(request_id).cast("string"), "dispatch_run_id": F.lit(run_id).cast("string")}), now,
                         stage_name="INGEST_CONTROL", stage_status=status, status_reason=f"batch_id={batch_id}; {reason}", cnt_row_written=None)


def load(spark: SparkSession, feed: Feed, refs: DataFrame, bronze_path: str, log_dir: str, batch_id: str, request_id: str | None,
         run_id: str | None, now, partition_cols: list[str] | None = None, seed: list[str] | None = None,
         policy: str = "FIRST_FILE", load_id: str | None = None, rules: DataFrame | None = None) -> DataFrame:
    """Ingest into a bronze folder, write the logs and commit; returns the counts to mark in the inventory.

    The start is logged before any file is read, so a load that dies leaves its files as started. Rows, logs and file
    states are parts of this load only; they count from the moment its manifest is written, which is the last step
    (``operators.commits``). ``load_id`` defaults to a name made of the batch and its files: a load that is repeated
    replaces what its first attempt left. Columns of ``refs`` beyond path, name and fingerprint, such as size
    and time, go into the manifest.

    Where ``rules``, the rule table, has active rules for the feed, they decide which rows are loaded: failing rows go, or into the table
    ``<bronze_path>_quarantine``; of a file that fails none are. Results, violations and notices are parts of the load, the status of each file is in its manifest.
    """
    began = time.monotonic()
    refs = stable(refs)
    load_id = load_id or commits.load_name(feed.feed_key, request_id, run_id, batch_id, refs)
    listed, refs = refs, refs.select("file_path", "file_name", "file_fingerprint")

    def ended():
        return F.lit(now).cast("timestamp") + F.make_dt_interval(secs=F.lit(max(0.001, time.monotonic() - began)))

    def commit(results: DataFrame, columns: list[str], at: Column) -> None:
        more = [c for c in listed.columns if c not in results.columns]
        files = results.join(listed.select("file_path", *more), "file_path") if more else results
        status = F.when(F.col("succeeded"), "LOADED_BRONZE").otherwise("DISCOVERED")
        failed = F.col("error") if "error" in results.columns else F.lit(None).cast("string")
        reason = F.when(F.col("succeeded"), "bronze load completed").otherwise(F.coalesce(failed, "parse_reason", F.lit("discovered")))
        commits.publish(files.withColumns({
            "load_status": status, "status_reason": reason, "ended": at, "ts_discovered": F.lit(now).cast("timestamp"), "promote_status": F.lit("NOT_READY"),
            **{c: F.lit("N") for c in ("flg_latest", "flg_superseded", "flg_legit_for_silver")}}), bronze_path, load_id, columns)

    logs.append_log(start_log(feed, refs, batch_id, request_id, run_id, now), f"{log_dir}/file_log", f"{load_id}.{commits.BEGAN}")
    known = commits.known_columns(spark, bronze_path, but=load_id)
    existing = drift.initial_columns(policy, seed) if known is None else known
    try:
        batch = read_batch(spark, feed, refs, batch_id, request_id, run_id, now, numbered=rules is not None)
    except LoadFailed as exc:
        at = ended()
        logs.append_log(start_log(feed, refs, batch_id, request_id, run_id, at, "FAILED", f"ingest failed: {exc}"), f"{log_dir}/file_log", load_id)
        files = parse_filename(refs.withColumn("feed_key", F.lit(feed.feed_key)), feed.regex, feed.capture_spec)
        commit(files.withColumns({"succeeded": F.lit(False), "request_id": F.lit(request_id), "dispatch_run_id": F.lit(run_id)}), existing, at)
        raise
    checked = run_quality(rules, feed.feed_key, batch.rows, str(now)[:10])
    rows = drift.evolve_business(checked.kept if checked else batch.rows.drop("src_row_number"), existing)
    commits.write_part(rows, bronze_path, load_id, partition_cols)
    counts = stable(bronze.bronze_counts(bronze.read_load(spark, bronze_path, load_id)))
    at = ended()
    run = report(feed, batch, counts, existing, bronze_path, batch_id, request_id, run_id, at, checked)
    results, notices = stable(run.results), run.notifications
    if checked:
        told = write_quality(checked, results, feed.feed_key, f"{bronze_path}_quarantine", log_dir, load_id, at, request_id, run_id)
        notices = notices.unionByName(told.withColumn("resolved_recipients", logs.recipients(F.lit(feed.recipients).cast("string"), None)))
    status = logs.batch_status(results)
    for name, table in (("file_log", run.file_log), ("schema_change_log", run.schema_changes), ("notifications", notices),
                        ("job_log", logs.job_log(status, at, request_id=request_id, task_name="ingest_batch", dispatch_run_id=run_id))):
        logs.append_log(table, f"{log_dir}/{name}", load_id)
    commit(results.withColumn("cnt_row_bronze", F.col("cnt_row_written")), drift.united(existing, drift.business_columns(rows)), at)
    return results.filter("succeeded").select("file_fingerprint", F.col("cnt_row_written").alias("cnt_row_bronze"), "request_id", "dispatch_run_id")
