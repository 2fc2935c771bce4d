"""Logs, notifications, rollback, stage composites and the registry."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedyard import schemas
from feedyard.functions.masking import mask_columns
from feedyard.functions.text import parse_utc, quote_literal, quote_name
from feedyard.operators import bronze, inventory, lineage, logs, promote, rollback
from feedyard.plans import intake, stages

NOW = "2026-01-15 12:00:00"


def test_every_oracle_has_its_query():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert len(queries) > 100 and set(oracles) <= set(queries)


def test_notifications(spark):
    df = spark.createDataFrame([("warning", " Schema ", "", "r", "m", "a@b", None), ("INFO", "PARSE", "f", " ", "m", None, "c@d")],
                               "severity string, category string, feed_key string, request_id string, message string, feed_mail string, env_mail string")
    rows = logs.notifications(df.withColumn("resolved_recipients", logs.recipients(F.col("feed_mail"), F.col("env_mail"))), NOW, event_type="parse_failed").collect()
    assert [(r["severity"], r["category"], r["feed_key"], r["request_id"], r["event_type"], r["resolved_recipients"]) for r in rows] == [
        ("WARNING", "SCHEMA", None, "r", "PARSE_FAILED", "a@b"), ("INFO", "PARSE", "f", None, "PARSE_FAILED", "c@d")]
    assert list(rows[0].asDict()) == schemas.names(schemas.NOTIFICATIONS) and len({r["event_id"] for r in rows}) == 2
    for bad in ({"severity": "CRITICAL"}, {"category": "OTHER"}):
        with pytest.raises(Exception, match="invalid"):
            logs.notifications(df, NOW, event_type="x", **bad).collect()


def test_log_shapes(spark):
    df = spark.createDataFrame([("f", "p", None, "n")], "feed_key string, file_path string, file_fingerprint string, file_name string")
    r = logs.file_log(df, NOW, stage_name="DISCOVERY", stage_status="SUCCEEDED").first()
    assert r["file_fingerprint"] == "" and list(r.asDict()) == schemas.names(schemas.FILE_LOG)
    assert logs.file_log(df, NOW).schema["file_date"].dataType.typeName() == "date"


def test_text_helpers(spark):
    assert quote_name("a`b.c") == "`a``b.c`" and quote_literal("it's") == "'it''s'"
    texts = [("2026-01-01T00:00:00Z", "2026-01-01 00:00:00"), ("2026-01-01 02:00:00+02:00", "2026-01-01 00:00:00"), (" 2026-01-01 ", "2026-01-01 00:00:00"), ("soon", None), ("", None), (None, None), ("12:30", None)]
    got = spark.createDataFrame([(t,) for t, _ in texts], "t string").select(parse_utc(F.col("t"))).collect()
    assert [None if r[0] is None else str(r[0]) for r in got] == [w for _, w in texts]


def test_masking(spark):
    r = mask_columns(spark.createDataFrame([("abcdef", "x.y", None)], "a string, `b.c` string, d string"), {"a": "partial", "b.c": "redact", "d": "redact"}).first()
    assert (r["a"], r["b.c"], r["d"]) == ("**cdef", "***", None)
    with pytest.raises(ValueError):
        mask_columns(spark.range(1), {"nope": "hash"})


def test_rollback_is_scoped_and_compares_normalised_paths(spark):
    log = spark.createDataFrame([("f", "r1", "q", "dbfs:/Volumes/a"), ("f", "r2", "q", "dbfs:/Volumes/b"), ("g", "r1", "q", "dbfs:/Volumes/c")], "feed_key string, dispatch_run_id string, request_id string, file_path string")
    inv = spark.createDataFrame([("f", "r1", "q"), ("f", "r2", "q"), ("g", "r1", "q")], "feed_key string, dispatch_run_id string, request_id string")
    # another feed may have loaded a file of the same path
    rows = spark.createDataFrame([("f", "/Volumes/a"), ("f", "/Volumes/b"), ("g", "/Volumes/c"), ("g", "/Volumes/a")], "feed_key string, src_file_path string")
    tables = {"file_log": log, "inventory": inv, "bronze": rows, "config": spark.createDataFrame([("f",), ("g",)], "feed_key string")}
    assert {r["table_name"]: r["cnt_rows"] for r in rollback.plan(tables, "f", "r1").collect()} == {"file_log": 1, "inventory": 1, "candidate_file_paths": 1, "bronze": 1}
    left = rollback.apply(tables, "f", "r1")
    assert {n: d.count() for n, d in left.items()} == {"file_log": 2, "inventory": 2, "bronze": 3, "config": 2}
    assert rollback.apply(tables, "f", purge_config=True)["config"].count() == 1


def test_double_loads_and_retention(spark):
    df = spark.createDataFrame([("fp", "r1", "2026-01-01", "f"), ("fp", "r2", "2026-01-02", "f"), ("fp2", "r2", "2025-01-02", "g")], "src_file_fingerprint string, request_id string, ts_ingest string, feed_key string")
    df = df.withColumn("ts_ingest", F.col("ts_ingest").cast("timestamp"))
    assert sorted((r["src_file_fingerprint"], r["request_id"]) for r in bronze.dedup_loads(df).collect()) == [("fp", "r1"), ("fp2", "r2")]
    cfg = spark.createDataFrame([("f", 5), ("g", None)], "feed_key string, gov_retention_days int")
    assert bronze.apply_retention(df, cfg, "2026-01-06 12:00:00").count() == 2
    assert bronze.partition_columns(" a, ,b ") == ["a", "b"] and bronze.partition_columns(None) == []


def test_double_loads_meet_by_packed_fingerprints(spark):
    digest = "0f" * 32
    df = spark.createDataFrame([(digest, "r1", 1), (digest, "r2", 2), (None, "r1", 1), (None, None, 2), ("0F" * 32, "r2", 1), ("", "r3", 1), ("", "r4", 2)],
                               "src_file_fingerprint string, request_id string, ts_ingest int")
    out = bronze.dedup_loads(df)
    assert out.columns == df.columns
    assert sorted(map(repr, ((r[0], r[1]) for r in out.collect()))) == sorted(map(repr, [(digest, "r1"), (None, None), ("0F" * 32, "r2"), ("", "r3")]))
    assert "hashpartitioning(src_file_fingerprint" not in out._jdf.queryExecution().executedPlan().toString()


def _adjudicable(spark):
    """A ready file, a superseded version of it, one not loaded, one without rows, one whose name failed, whose reason claims the opposite."""
    rows = [("11" * 32, "p1", "d1", 1, "PARSED", None, "LOADED_BRONZE", 3), ("22" * 32, "p1", "d1", 0, "PARSED", None, "LOADED_BRONZE", 3), ("33" * 32, "p2", "d2", 0, "PARSED", None, "DISCOVERED", None),
            ("odd", "p3", "d3", 0, "PARSED", None, "LOADED_BRONZE", 0), ("55" * 32, None, None, 0, "PARSE_FAILED", "latest and ready for silver", "LOADED_BRONZE", 3), ("plain", "p4", "d4", 0, "PARSED", None, None, 7)]
    df = spark.createDataFrame(rows, "file_fingerprint string, part_group_key string, delivery_group_key string, file_version_rank int, parse_status string, parse_reason string, load_status string, cnt_row_bronze bigint")
    return df.select([F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in schemas.fields(schemas.INVENTORY)])


def test_silver_shuffles_ready_files_only(spark):
    known = _adjudicable(spark)
    loaded = spark.createDataFrame([(r["file_fingerprint"], str(i)) for i, r in enumerate(known.collect())] + [(None, "9"), ("plain", "x")], "src_file_fingerprint string, n string")
    out = promote.to_silver(loaded, inventory.adjudicate(known), [("n", "k", "int"), ("src_file_fingerprint", "f", "string")])
    assert sorted(map(repr, ((r["src_file_fingerprint"], r["k"], r["f"]) for r in out.collect()))) == sorted(map(repr, [("11" * 32, 0, "11" * 32), ("plain", 5, "plain"), ("plain", None, "plain")]))
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line and "_print" in line]
    # the verdicts are met by an inner join, so what is not ready is left out on both sides before it is shuffled
    assert sum("Join Inner" in line for line in joins) == 1 and not any("LeftOuter" in line for line in joins)


def test_finalize_keeps_only_verdicts(spark, monkeypatch):
    wrote, keep = [], stages.kept
    monkeypatch.setattr(stages, "kept", lambda df: wrote.append(df.columns) or keep(df))
    done = stages.run_finalize(_adjudicable(spark), NOW, "run")
    assert wrote == [["_print", "_verdict"]]
    reasons = {r["file_fingerprint"]: (r["status_reason"], r["stage_status"]) for r in done.file_log.collect()}
    assert reasons["11" * 32] == ("latest and ready for silver", "READY_FOR_SILVER") and reasons["22" * 32][0] == "superseded by newer version"
    assert reasons["55" * 32][1] == "NOT_READY" and done.table.columns == schemas.names(schemas.INVENTORY) and done.table.count() == 6


def test_stages_from_request_to_verdict(spark):
    """A feed's files asked for, recorded, loaded and adjudicated; a second request finds them done."""
    config = spark.createDataFrame([("f", r"^(a)_(\d{8})_(\d)_(\d)\.txt$", "1|vendor_code|string;2|file_date|date_yyyymmdd;3|file_part_seq|int;4|file_part_tot|int", "FILE_MODIFIED_TS", 1440, 10, 1.0, "ops")],
                                   "feed_key string, src_file_regex string, src_file_capture_spec string, sched_selector_type string, sched_lookback_minutes int, batch_max_files int, batch_max_size_gb double, notify_recipients string")
    names = ["a_20260115_1_2.txt", "a_20260115_2_2.txt", "other.txt"]
    listing = spark.createDataFrame([("f", n, f"dbfs:/d/{n}", f"fp_{n}", 10, 10, 1768476600000) for n in names],
                                    "feed_key string, file_name string, file_path string, file_fingerprint string, file_size bigint, src_size bigint, src_mtime_ms bigint")
    empty_inv = spark.createDataFrame([], schemas.INVENTORY)
    log = spark.createDataFrame([], "event_id string, file_fingerprint string, file_path string, stage_name string, stage_status string, ts_event timestamp")
    ask = spark.createDataFrame([("f", "r1", "", "dbfs:/d")], "feed_key string, request_id string, request_json string, source_dir string")
    first = intake.run_intake(ask, listing, config, empty_inv, log, NOW, run_id="d")
    assert first.summary.first()["status_code"] == "READY_TO_PROCESS" and first.batches.count() == 1
    assert first.notifications.count() == 0 and first.file_log.groupBy("stage_status").count().count() == 2
    record = intake.request_log(first, NOW).first()
    assert set(schemas.names(schemas.REQUEST_LOG)) <= set(record.asDict()) and len(record["arr_paths_final_eligible"]) == 2 and len(record["arr_batch_inputs"]) == 1
    from feedyard.functions.filenames import name_rules, parse_by_rules
    parsed = parse_by_rules(listing.join(name_rules(config), "feed_key"))
    manifest = stages.run_manifest(empty_inv, first.flags, parsed, NOW, "d")
    assert manifest.table.count() == 2 and manifest.summary.first()["parsed_file_count"] == 2
    from feedyard.operators.inventory import mark_loaded
    loads = manifest.table.select("file_fingerprint", F.lit(3).cast("bigint").alias("cnt_row_bronze"), F.lit("r1").alias("request_id"), F.lit("d").alias("dispatch_run_id"))
    final = stages.run_finalize(mark_loaded(manifest.table, loads), NOW)
    assert final.summary.first()["ready_for_silver_count"] == 2 and "ready_for_silver_count=2" in final.job_log.first()["status_reason"]
    again = intake.run_intake(ask, listing, config, final.table, log, NOW)
    assert again.summary.first()["status_code"] == "NO_ELIGIBLE_FILES"
    note = again.notifications.first()
    assert note["event_type"] == "NO_ELIGIBLE_FILES" and note["details_json"] == '{"requested_count":3,"rejected_count":3}' and note["resolved_recipients"] == "ops"


def test_config_sync_stages(spark):
    def raw(rows):
        return spark.createDataFrame(rows, "feed_key string, tgt_bronze_table string, ctl_sync_config string, sched_cron string, config_source_file string, m int, row_no bigint").withColumn("config_source_mtime", F.timestamp_seconds("m"))
    first = stages.run_config_sync(raw([("f", "t", "N", "1", "a", 1, 0), ("f", "t2", "N", "2", "b", 2, 0), ("g", "t", "N", "3", "a", 1, 1)]), None, "/Volumes/m/l", NOW, "d")
    assert first.table.count() == 2 and first.job_log.first()["task_status"] == "WARNING" and first.notifications.first()["event_type"] == "DUPLICATE_CONFIG_RESOLVED"
    second = stages.run_config_sync(raw([("f", "t9", "N", "9", "a", 1, 0), ("g", "t9", "Y", "9", "a", 1, 1), ("h", "t", "N", "1", "a", 1, 2)]), first.table, "/Volumes/m/l", NOW, "d")
    assert {r["feed_key"]: r["sched_cron"] for r in second.table.collect()} == {"f": "2", "g": "9", "h": "1"}
    assert [r["feed_key"] for r in second.summary.collect()] == ["h"]
    nothing = stages.run_config_sync(raw([(" ", "t", "N", "1", "a", 1, 0)]), first.table, "/", NOW, "d")
    assert nothing.notifications.first()["event_type"] == "EMPTY_CONFIG"
    with pytest.raises(ValueError, match="requires src_uri"):
        stages.run_config_sync(raw([("f", "t", "N", "1", "a", 1, 0)]), None, "/", NOW, "d", require_src_uri=True, env="prod")


def test_file_lifecycle_sends_fingerprints_packed_and_no_event_ids(spark):
    digest = "0" * 63 + "a"
    inv = spark.createDataFrame([("f", p, f"d/{i}", "LOADED_BRONZE", "NOT_READY", 1) for i, p in enumerate((digest, "plain", "unseen"))],
                                "feed_key string, file_fingerprint string, file_path string, load_status string, promote_status string, cnt_row_bronze bigint")
    log = spark.createDataFrame([(f"e{i}", p, s, t) for i, (p, s, t) in enumerate((
        (digest, "STARTED", "2026-01-01"), (digest, "SUCCEEDED", "2026-01-02"), ("plain", "STARTED", "2026-01-03"), ("plain", "FAILED", "2026-01-03"), ("plain", None, "2026-01-02"), ("", "FAILED", "2026-01-04")))],
        "event_id string, file_fingerprint string, stage_status string, ts string").withColumn("ts_event", F.col("ts").cast("timestamp"))
    loaded = spark.createDataFrame([(digest,), (digest,), (None,), ("stray",)], "src_file_fingerprint string")
    out = lineage.file_lifecycle(inv, log, bronze.bronze_counts(loaded, keyed=True))
    got = {r["file_fingerprint"]: (r["cnt_events"], str(r["ts_first"])[:10], str(r["ts_last"])[:10], r["last_status"], r["cnt_found"]) for r in out.collect()}
    assert got == {digest: (2, "2026-01-01", "2026-01-02", "SUCCEEDED", 2), "plain": (3, "2026-01-02", "2026-01-03", "FAILED", None), "unseen": (None, "None", "None", None, None)}
    assert {r["file_fingerprint"]: r["cnt_found"] for r in lineage.file_lifecycle(inv, log, bronze.bronze_counts(loaded)).collect()} == {digest: 2, "plain": None, "unseen": None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lineage.file_lifecycle(inv, log, bronze.bronze_counts(loaded, keyed=True))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(file_fingerprint#" not in plan and plan.count("hashpartitioning(_print#") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
