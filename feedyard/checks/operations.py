"""Logs, notifications, rollback, reconciliation, promotion and the stage composites."""
from __future__ import annotations

from pyspark.sql import functions as F

from feedyard.checks import views as v
from feedyard.functions import masking
from feedyard.operators import bronze as br, inventory, lineage, logs, promote, rollback
from feedyard.plans import intake, stages

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


def _notices(spark, sf_dir):
    """User events as notifications."""
    ev = v.event_log(spark, sf_dir)
    severity = F.when(F.col("stage_status") == "FAILED", " error").when(F.col("stage_status") == "STARTED", "Warning").otherwise("INFO")
    rows = ev.withColumns({"severity": severity, "details": F.struct("stage_status", "file_name"), "message": F.concat(F.lit("file "), "file_name"),
                           "resolved_recipients": logs.recipients(F.when(F.pmod(F.col("file_name").cast("int"), F.lit(2)) == 0, F.concat(F.lit(" "), "feed_key")), F.when(F.pmod(F.col("file_name").cast("int"), F.lit(3)) == 0, "all ")),
                           "request_id": F.when(F.col("request_id") != "req_0", F.col("request_id")).otherwise(" ")})
    return logs.notifications(rows, v.EVENTS_NOW, category="ingestion", event_type=" parse_failed ").drop("ts_event").join(ev.select("event_id", "ts_event"), "event_id")


_NOTICES = """v_notices AS (
  SELECT event_id, CASE stage_status WHEN 'FAILED' THEN 'ERROR' WHEN 'STARTED' THEN 'WARNING' ELSE 'INFO' END AS severity, 'INGESTION' AS category,
    'PARSE_FAILED' AS event_type, feed_key, nullif(request_id, 'req_0') AS request_id, 'file ' || file_name AS message,
    '{"stage_status":"' || stage_status || '","file_name":"' || file_name || '"}' AS details_json,
    CASE WHEN file_name::INT % 3 = 0 THEN 'all' WHEN file_name::INT % 2 = 0 THEN feed_key END AS resolved_recipients, ts_event FROM v_event_log)"""
_NOTICE_COLS = "event_id, severity, category, event_type, feed_key, request_id, message, details_json, resolved_recipients"


@query(v.sql("event_log", f"SELECT {_NOTICE_COLS} FROM v_notices", _NOTICES))
def notifications(spark, sf_dir):
    return _notices(spark, sf_dir).select(*_NOTICE_COLS.split(", "))


@query(v.sql("event_log", f"""SELECT event_id, severity, ts_event FROM v_notices WHERE severity = 'ERROR' AND ts_event >= TIMESTAMP '{v.EVENTS_NOW}' - INTERVAL 240 HOUR
ORDER BY ts_event DESC, event_id DESC LIMIT 50""", _NOTICES))
def recent_events(spark, sf_dir):
    return logs.recent(_notices(spark, sf_dir), 50, v.EVENTS_NOW, 240, "ERROR").select("event_id", "severity", "ts_event")


@query(v.sql("event_log", """SELECT n.event_id, c.channel, n.severity FROM v_notices n JOIN (VALUES ('ERROR', 'mail'), ('ERROR', 'chat'), ('WARNING', 'chat')) c(severity, channel) ON n.severity = c.severity
LEFT JOIN (SELECT event_id FROM v_event_log WHERE value < 10) s ON s.event_id = n.event_id AND c.channel = 'mail' WHERE s.event_id IS NULL""", _NOTICES))
def notification_outbox(spark, sf_dir):
    sent = v.event_log(spark, sf_dir).select("event_id", F.lit("mail").alias("channel"), F.when(F.col("value") < 10, "SENT").otherwise("FAILED").alias("delivery_status"))
    channels = spark.createDataFrame([("ERROR", "mail"), ("ERROR", "chat"), ("WARNING", "chat")], "severity string, channel string")
    return logs.outbox(_notices(spark, sf_dir), sent, channels).select("event_id", "channel", "severity")


@query(v.sql("event_log", """SELECT event_id, 'ingest_batch' AS task_name, stage_status AS task_status, feed_key, dispatch_run_id,
  coalesce(file_fingerprint, '') AS file_fingerprint, 'a,b' AS source_columns_csv, file_name AS target_columns_csv FROM v_event_log"""))
def log_records(spark, sf_dir):
    """Job, file and schema-change records of the same events, side by side."""
    ev = v.event_log(spark, sf_dir)
    job = logs.job_log(ev, v.EVENTS_NOW, task_name="ingest_batch", task_status=F.col("stage_status"))
    file = logs.file_log(ev.withColumn("file_fingerprint", F.nullif("file_fingerprint", F.lit(""))), v.EVENTS_NOW)
    change = logs.schema_change_log(ev.withColumns({
        "source_columns": F.array(F.lit("a"), F.lit("b")), "target_columns": F.array("file_name"), "missing_in_file": F.array("file_name"),
        "new_in_file": F.array(F.lit("a")), "change_detected": F.lit("Y"), "status_reason": F.lit("x")}), v.EVENTS_NOW, target_table="t")
    return job.select("event_id", "task_name", "task_status", "feed_key", "dispatch_run_id").join(file.select("event_id", "file_fingerprint"), "event_id").join(
        change.select("event_id", "source_columns_csv", "target_columns_csv"), "event_id")


@query("""SELECT l_suppkey % 7 AS feed_no, l_suppkey AS batch_no, count(*)::BIGINT AS file_count, count(*) FILTER (l_returnflag <> 'R')::BIGINT AS succeeded,
  count(*) FILTER (l_returnflag = 'R')::BIGINT AS failed, coalesce(sum(l_quantity) FILTER (l_returnflag <> 'R'), 0)::BIGINT AS total_rows_written,
  CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN 'SUCCEEDED' WHEN count(*) FILTER (l_returnflag <> 'R') > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS task_status
FROM lineitem GROUP BY 1, 2""")
def batch_status(spark, sf_dir):
    li = v.table(spark, sf_dir, "lineitem").select(
        F.pmod("l_suppkey", F.lit(7)).alias("feed_key"), F.col("l_suppkey").alias("batch_id"), (F.col("l_returnflag") != "R").alias("succeeded"),
        F.col("l_quantity").cast("bigint").alias("cnt_row_written"))
    return logs.batch_status(li).select(F.col("feed_key").alias("feed_no"), F.col("batch_id").alias("batch_no"), "file_count", "succeeded", "failed", "total_rows_written", "task_status")


# ---- rollback and reconciliation -------------------------------------------------------------

def _bronze(spark, sf_dir):
    """One bronze row per order line of a loaded file; lines of heavy discount were loaded twice."""
    li = v.listed_files(spark, sf_dir)
    twice = F.when(F.col("discount") > 0.08, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return li.select("feed_key", F.concat(F.lit("/Volumes"), F.substr(F.col("file_path"), F.lit(len("dbfs:/Volumes") + 1))).alias("src_file_path"),
                     F.col("file_fingerprint").alias("src_file_fingerprint"), F.col("l_orderkey").cast("string").alias("order_id"), F.col("price").cast("decimal(12,2)").cast("string").alias("price"),
                     F.date_format("ship", "yyyy-MM-dd").alias("shipped"), F.explode(twice).alias("load_no")).withColumns({
                         "request_id": F.concat(F.lit("req_"), "load_no"), "ts_ingest": F.col("shipped").cast("timestamp") + F.make_dt_interval(days=F.col("load_no"))})


_BRONZE = """v_bronze AS (
  SELECT feed_key, replace(file_path, 'dbfs:', '') AS src_file_path, file_fingerprint AS src_file_fingerprint, o::VARCHAR AS order_id, price, ship, load_no,
    'req_' || load_no AS request_id, ship + to_days(load_no) AS ts_ingest
  FROM v_files, LATERAL (SELECT unnest(CASE WHEN discount > 0.08 THEN [1, 2] ELSE [1] END)::INT AS load_no))"""


def _tables(spark, sf_dir):
    log = v.event_log(spark, sf_dir).unionByName(
        v.ingest_log(spark, sf_dir).withColumns({"value": F.lit(0.0), "dispatch_run_id": F.lit("run_1"), "request_id": F.lit("req_1")}))
    job = v.event_log(spark, sf_dir).select("event_id", "feed_key", "dispatch_run_id", "request_id")
    return {"file_log": log, "job_log": job, "inventory": v.inventory(spark, sf_dir), "bronze": _bronze(spark, sf_dir)}


_LOGS = """v_log AS (SELECT feed_key, file_path, dispatch_run_id, request_id, event_id FROM v_event_log UNION ALL SELECT feed_key, file_path, 'run_1', 'req_1', event_id FROM v_ingest_log),
v_touched AS (SELECT DISTINCT file_path FROM v_log WHERE feed_key = 'feed_3' AND dispatch_run_id = 'run_1')"""
_RB_VIEWS = "inventory ingest_log event_log"


@query(v.sql(_RB_VIEWS, """
SELECT 'job_log' AS table_name, count(*) AS cnt_rows FROM v_event_log WHERE feed_key = 'feed_3' AND dispatch_run_id = 'run_1' UNION ALL
SELECT 'file_log', count(*) FROM v_log WHERE feed_key = 'feed_3' AND dispatch_run_id = 'run_1' UNION ALL
SELECT 'inventory', count(*) FROM v_inventory WHERE feed_key = 'feed_3' AND dispatch_run_id = 'run_1' UNION ALL
SELECT 'candidate_file_paths', count(*) FROM v_touched UNION ALL
SELECT 'bronze', count(*) FROM v_bronze WHERE feed_key = 'feed_3' AND 'dbfs:' || src_file_path IN (SELECT file_path FROM v_touched)""", _BRONZE + ",\n" + _LOGS))
def rollback_plan(spark, sf_dir):
    return rollback.plan(_tables(spark, sf_dir), "feed_3", " run_1 ")


@query(v.sql(_RB_VIEWS, """
SELECT 'job_log' AS table_name, count(*) AS cnt_rows FROM v_event_log WHERE NOT (feed_key = 'feed_3' AND dispatch_run_id = 'run_1') UNION ALL
SELECT 'file_log', count(*) FROM v_log WHERE NOT (feed_key = 'feed_3' AND dispatch_run_id = 'run_1') UNION ALL
SELECT 'inventory', count(*) FROM v_inventory WHERE NOT (feed_key = 'feed_3' AND dispatch_run_id = 'run_1') UNION ALL
SELECT 'bronze', count(*) FROM v_bronze WHERE NOT (feed_key = 'feed_3' AND 'dbfs:' || src_file_path IN (SELECT file_path FROM v_touched))""", _BRONZE + ",\n" + _LOGS))
def rollback_apply(spark, sf_dir):
    left = rollback.apply(_tables(spark, sf_dir), "feed_3", "run_1")
    out = None
    for name, df in left.items():
        one = df.agg(F.count(F.lit(1)).alias("cnt_rows")).select(F.lit(name).alias("table_name"), "cnt_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query(v.sql("inventory", """SELECT file_fingerprint, CASE WHEN feed_key = 'feed_5' THEN 'feed_new' ELSE feed_key END AS feed_key,
  CASE WHEN feed_key = 'feed_5' THEN 'feed_new' || substr(part_group_key, 7) ELSE part_group_key END AS part_group_key FROM v_inventory WHERE feed_key <> 'feed_6'"""))
def feed_rename(spark, sf_dir):
    """One feed renamed, another taken out."""
    tables = rollback.purge_feed(rollback.rename_feed({"inventory": v.inventory(spark, sf_dir)}, "feed_5", "feed_new"), "feed_6")
    return tables["inventory"].select("file_fingerprint", "feed_key", "part_group_key")


@query(v.sql("files", "SELECT src_file_fingerprint, request_id, order_id FROM v_bronze WHERE load_no = 1", _BRONZE))
def bronze_dedup(spark, sf_dir):
    return br.dedup_loads(_bronze(spark, sf_dir)).select("src_file_fingerprint", "request_id", "order_id")


@query(v.sql("inventory", """SELECT coalesce(i.file_fingerprint, b.fp) AS file_fingerprint, cnt_claimed, coalesce(n, 0) AS cnt_found,
  CASE WHEN i.file_fingerprint IS NULL THEN 'NOT_IN_INVENTORY' WHEN cnt_claimed > 0 AND coalesce(n, 0) = 0 THEN 'MISSING_IN_BRONZE' ELSE 'COUNT_MISMATCH' END AS difference
FROM (SELECT file_fingerprint, coalesce(cnt_row_bronze, 0) AS cnt_claimed FROM v_inventory WHERE load_status = 'LOADED_BRONZE') i
FULL JOIN (SELECT src_file_fingerprint AS fp, count(*) AS n FROM v_bronze GROUP BY 1) b ON i.file_fingerprint = b.fp
WHERE i.file_fingerprint IS NULL OR cnt_claimed <> coalesce(n, 0)""", _BRONZE))
def reconcile(spark, sf_dir):
    return inventory.reconcile(v.inventory(spark, sf_dir), br.bronze_counts(_bronze(spark, sf_dir)))


@query(v.sql("inventory ingest_log", """SELECT i.file_fingerprint, load_status, coalesce(e.n, 0) AS cnt_events, e.first_at AS ts_first, e.last_at AS ts_last, e.last_status, b.n AS cnt_found
FROM v_inventory i LEFT JOIN (SELECT file_fingerprint AS fp, count(*) AS n, min(ts_event) AS first_at, max(ts_event) AS last_at, arg_max(stage_status, ts_event) AS last_status
  FROM v_ingest_log WHERE file_fingerprint <> '' GROUP BY 1) e ON e.fp = i.file_fingerprint
LEFT JOIN (SELECT src_file_fingerprint AS fp, count(*) AS n FROM v_bronze GROUP BY 1) b ON b.fp = i.file_fingerprint""", _BRONZE))
def file_lifecycle(spark, sf_dir):
    return lineage.file_lifecycle(v.inventory(spark, sf_dir), v.ingest_log(spark, sf_dir), br.bronze_counts(_bronze(spark, sf_dir), keyed=True)).select(
        "file_fingerprint", "load_status", F.coalesce("cnt_events", F.lit(0)).alias("cnt_events"), "ts_first", "ts_last", "last_status", "cnt_found")


@query(v.sql("adjudicated", """SELECT src_file_fingerprint, order_id::BIGINT AS order_key, price::DECIMAL(12,2)::DOUBLE AS amount, ship::DATE AS ship_date
FROM v_bronze WHERE src_file_fingerprint IN (SELECT file_fingerprint FROM v_adjudicated WHERE flg_legit_for_silver = 'Y')""", _BRONZE))
def silver_promote(spark, sf_dir):
    return promote.to_silver(_bronze(spark, sf_dir), inventory.adjudicate(v.inventory(spark, sf_dir)), [
        ("order_id", "order_key", "bigint"), ("price", "amount", "double"), ("shipped", "ship_date", "date")])


@query("""SELECT c_custkey, sha256(c_custkey::VARCHAR) AS key_hash, '***' AS segment, repeat('*', greatest(length(c_name) - 4, 0)::INT) || right(c_name, 4) AS name, NULL::VARCHAR AS note FROM customer""")
def mask_columns(spark, sf_dir):
    c = v.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("key_hash"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.lit("x").alias("note"))
    return masking.mask_columns(c, {"key_hash": "hash", "segment": "redact", "name": "partial", "note": "null"})


@query(r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+', '[EMAIL]', 'g'), '[0-9]{3}-[0-9]{4}', '[PHONE]', 'g')) AS masked,
  text <> regexp_replace(regexp_replace(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+', '[EMAIL]', 'g'), '[0-9]{3}-[0-9]{4}', '[PHONE]', 'g') AS changed FROM documents""")
def mask_text(spark, sf_dir):
    d = v.table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("masked"))
    out = masking.mask_patterns(d, "masked", {"EMAIL": r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+", "PHONE": r"[0-9]{3}-[0-9]{4}"})
    return out.select("doc_id", F.sha2("masked", 256).alias("masked"), (F.col("text") != F.col("masked")).alias("changed"))


@query(v.sql("files", f"""SELECT src_file_fingerprint, load_no FROM v_bronze WHERE feed_key NOT IN ('feed_1', 'feed_2')
  OR ts_ingest >= TIMESTAMP '{v.NOW}' - to_days(CASE feed_key WHEN 'feed_1' THEN 30 ELSE 900 END)""", _BRONZE))
def retention(spark, sf_dir):
    days = F.when(F.col("feed_key") == "feed_1", 30).when(F.col("feed_key") == "feed_2", 900)
    return br.apply_retention(_bronze(spark, sf_dir), v.feeds(spark, sf_dir).withColumn("gov_retention_days", days), v.NOW).select("src_file_fingerprint", "load_no")


# ---- composites ------------------------------------------------------------------------------

def _intake(spark, sf_dir, sub_keys=False):
    """Feeds ask in turn for everything of two years, for a discovery, or with a broken request.

    With ``sub_keys`` each feed has two more, one whose pattern fits no file and one, later by name, with the pattern of all files.
    """
    n = F.regexp_extract("feed_key", r"\d+", 0).cast("int")
    config = v.feeds(spark, sf_dir).withColumns({"batch_max_size_gb": F.lit(1.0), "notify_recipients": F.lit("ops")})
    asking = config
    if sub_keys:
        wide = {"batch_max_files": F.lit(10_000), "notify_recipients": F.lit("others"), "sched_lookback_minutes": F.lit(5)}
        config = config.unionByName(config.withColumns({"feed_sub_key": F.lit("A"), "src_file_regex": F.lit(r"^no such (\d+)$"), "src_file_capture_spec": F.lit("1|vendor_code|string"), **wide}))
        config = config.unionByName(asking.withColumns({"feed_sub_key": F.lit("Z"), **wide}))
    ask = asking.select(
        "feed_key", F.concat(F.lit("req_"), "feed_key").alias("request_id"), F.concat(F.lit(v.ROOT + "/"), "feed_key", F.lit("/source")).alias("source_dir"),
        F.when(F.pmod(n, F.lit(5)) == 4, "nonsense").when(F.pmod(n, F.lit(5)) == 3, '{"request_type":"DISCOVERY"}').otherwise(
            '{"request_type":"BACKFILL","selector_type":"FILE_MODIFIED_TS","modified_from_ts":"1996-01-01","modified_to_ts":"1997-12-31T23:59:59Z"}').alias("request_json"))
    return intake.run_intake(ask, v.listed_files(spark, sf_dir), config, v.known_inventory(spark, sf_dir), v.ingest_log(spark, sf_dir), v.NOW, hours=8640, run_id="run_i")


_INTAKE = """v_marked AS (
  SELECT f.*, fn, 'req_' || f.feed_key AS request_id, NOT bad AND NOT (file_path IN (SELECT file_path FROM v_known WHERE load_status = 'LOADED_BRONZE')) AS eligible
  FROM v_files f JOIN v_feeds USING (feed_key) WHERE fn % 5 = 3 OR (fn % 5 < 3 AND mtime BETWEEN epoch_ms(TIMESTAMP '1996-01-01') AND epoch_ms(TIMESTAMP '1997-12-31 23:59:59'))),
v_stuck AS (SELECT identity FROM (
    SELECT identity, stage_status, row_number() OVER (PARTITION BY identity ORDER BY ts_event DESC, event_id DESC) AS rn
    FROM (SELECT *, CASE WHEN file_fingerprint = '' THEN file_path ELSE file_fingerprint END AS identity FROM v_ingest_log
          WHERE ts_event >= TIMESTAMP '1998-12-01' - INTERVAL 8640 HOUR)) WHERE rn = 1 AND stage_status = 'STARTED'),
v_marked2 AS (SELECT * REPLACE (eligible AND file_path NOT IN (SELECT identity FROM v_stuck) AND file_fingerprint NOT IN (SELECT identity FROM v_stuck) AS eligible) FROM v_marked),
v_eseq AS (SELECT feed_key, file_path, 2 + fn % 9 AS max_files, row_number() OVER (PARTITION BY feed_key ORDER BY file_path) AS rn FROM v_marked2 WHERE eligible AND fn % 5 < 3),
v_sums AS (SELECT feed_key, count(*) AS requested, count(*) FILTER (eligible) AS eligible FROM v_marked2 GROUP BY 1),
v_made AS (SELECT feed_key, least(max((rn - 1) // max_files + 1), 20) AS batches FROM v_eseq GROUP BY 1)"""
_INTAKE_VIEWS = "known ingest_log feeds"


_INTAKE_SQL = v.sql(_INTAKE_VIEWS, """SELECT feed_key, 'req_' || feed_key AS request_id, CASE WHEN fn % 5 = 4 THEN 'request_json must be a JSON object' WHEN fn % 5 = 3 THEN 'DISCOVERY_ONLY'
    WHEN coalesce(eligible, 0) > 0 THEN 'READY_TO_PROCESS' ELSE 'NO_ELIGIBLE_FILES' END AS status,
  coalesce(requested, 0) AS cnt_requested, coalesce(eligible, 0) AS cnt_final_eligible, coalesce(batches, 0) AS batch_count
FROM v_feeds LEFT JOIN v_sums USING (feed_key) LEFT JOIN v_made USING (feed_key)""", _INTAKE)


@query(_INTAKE_SQL)
def request_intake(spark, sf_dir):
    """Sizes stay far below the byte limit here, so the count limit alone makes the batches."""
    s = _intake(spark, sf_dir).summary
    return s.select("feed_key", "request_id", F.coalesce("request_error", "status_code").alias("status"), "cnt_requested", "cnt_final_eligible", "batch_count")


@query(_INTAKE_SQL)
def request_sub_keys(spark, sf_dir):
    """Feeds of three sub keys give the rows of feeds of one: each file is of the one it fits, nothing is counted twice."""
    s = _intake(spark, sf_dir, sub_keys=True).summary
    return s.select("feed_key", "request_id", F.coalesce("request_error", "status_code").alias("status"), "cnt_requested", "cnt_final_eligible", "batch_count")



@query(v.sql(_INTAKE_VIEWS, """SELECT feed_key, status_code, coalesce(len(requested), 0) AS requested, coalesce(len(eligible), 0) AS eligible, array_to_string(eligible, ',') AS eligible_paths, coalesce(batches, 0) AS batches FROM (
  SELECT feed_key, CASE WHEN fn % 5 = 3 THEN 'DISCOVERY_ONLY' WHEN count(*) FILTER (eligible) > 0 THEN 'READY_TO_PROCESS' ELSE 'NO_ELIGIBLE_FILES' END AS status_code,
    list(file_path ORDER BY file_path) AS requested, coalesce(list(file_path ORDER BY file_path) FILTER (eligible), []) AS eligible FROM v_marked2 GROUP BY feed_key, fn)
LEFT JOIN v_made USING (feed_key)""", _INTAKE))
def request_log(spark, sf_dir):
    rows = intake.request_log(_intake(spark, sf_dir), v.NOW)
    return rows.select("feed_key", "request_status_struct.status_code", F.size("arr_paths_requested").cast("bigint").alias("requested"), F.size("arr_paths_final_eligible").cast("bigint").alias("eligible"),
                       F.array_join("arr_paths_final_eligible", ",").alias("eligible_paths"), F.size("arr_batch_inputs").cast("bigint").alias("batches"))


@query(v.sql(_INTAKE_VIEWS, """SELECT f.feed_key, r.request_id, count(o.owner) AS packed, count(o.owner) AS recorded
FROM v_feeds f CROSS JOIN (VALUES ('req_1'), ('req_2'), ('req_3')) r(request_id) LEFT JOIN (
  SELECT feed_key, CASE WHEN mtime BETWEEN epoch_ms(TIMESTAMP '1996-01-01') AND epoch_ms(TIMESTAMP '1996-12-31 23:59:59') THEN 'req_1' ELSE 'req_2' END AS owner FROM v_files
  WHERE NOT bad AND mtime BETWEEN epoch_ms(TIMESTAMP '1996-01-01') AND epoch_ms(TIMESTAMP '1997-12-31 23:59:59')
    AND file_path NOT IN (SELECT file_path FROM v_known WHERE load_status = 'LOADED_BRONZE')
    AND file_path NOT IN (SELECT identity FROM v_stuck) AND file_fingerprint NOT IN (SELECT identity FROM v_stuck)) o
  ON o.feed_key = f.feed_key AND o.owner = r.request_id GROUP BY 1, 2""", _INTAKE))
def requests_of_one_feed(spark, sf_dir):
    """Three requests of every feed: its default one, a second that overlaps it, and a discovery; each file goes to one of the first two."""
    span = '{"request_type":"BACKFILL","selector_type":"FILE_MODIFIED_TS","modified_from_ts":"%s","modified_to_ts":"%s"}'
    config = v.feeds(spark, sf_dir).withColumns({"batch_max_size_gb": F.lit(1.0), "notify_recipients": F.lit("ops"),
                                                 "sys_default_request_json": F.lit(span % ("1996-01-01", "1996-12-31T23:59:59Z"))})
    texts = {"req_1": " ", "req_2": span % ("1996-07-01", "1997-12-31T23:59:59Z"), "req_3": '{"request_type":"DISCOVERY"}'}
    three = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(text).alias("text")) for k, text in texts.items()])
    ask = config.select("feed_key", F.concat(F.lit(v.ROOT + "/"), "feed_key", F.lit("/source")).alias("source_dir"), F.explode(three).alias("r")).select(
        "feed_key", "source_dir", F.col("r.id").alias("request_id"), F.col("r.text").alias("request_json"))
    known = v.known_inventory(spark, sf_dir)
    done = intake.run_intake(ask, v.listed_files(spark, sf_dir), config, known, v.ingest_log(spark, sf_dir), v.NOW, per_run=0, hours=8640, run_id="run_i")
    packed = done.batches.groupBy("feed_key", "request_id").agg(F.sum("file_count").alias("packed"))
    added = stages.run_manifest(known.limit(0), done.flags, v.parsed_files(spark, sf_dir), v.NOW, "run_i").table
    recorded = added.groupBy("feed_key", "request_id").agg(F.count(F.lit(1)).alias("recorded"))
    keys = ["feed_key", "request_id"]
    return ask.select(*keys).join(packed, keys, "left").join(recorded, keys, "left").select(*keys, F.coalesce("packed", F.lit(0)).alias("packed"), F.coalesce("recorded", F.lit(0)).alias("recorded"))


@query(v.sql(_INTAKE_VIEWS, """SELECT feed_key, 'req_' || feed_key AS request_id, file_path, file_fingerprint, file_name, 'DISCOVERY scaffold only; no bronze ingest performed' AS status_reason, 'run_i' AS dispatch_run_id
FROM v_marked2 WHERE fn % 5 = 3""", _INTAKE))
def discovery_log(spark, sf_dir):
    flags = _intake(spark, sf_dir).flags.filter("request_type = 'DISCOVERY'")
    return logs.discovery_log(flags, v.NOW, dispatch_run_id="run_i").select("feed_key", "request_id", "file_path", "file_fingerprint", "file_name", "status_reason", "dispatch_run_id")


@query(v.sql("config", """SELECT feed_key, feed_sub_key, 'dispatcher_dedup' AS task_name, n FROM (
  SELECT feed_key, feed_sub_key, count(*) - 1 AS n FROM v_filled GROUP BY 1, 2) WHERE n > 0"""))
def config_sync_log(spark, sf_dir):
    """Losing rows of a first sync are logged, one record each."""
    out = stages.run_config_sync(v.raw_config(spark, sf_dir), None, "/Volumes/main/landing", v.NOW, "run_c")
    key = F.regexp_extract("status_reason", r"^duplicate ([^:]+):", 1)
    return out.job_log.groupBy(F.split_part(key, F.lit("|"), F.lit(1)).alias("feed_key"), F.split_part(key, F.lit("|"), F.lit(2)).alias("feed_sub_key"), "task_name").agg(F.count(F.lit(1)).alias("n"))


@query(v.sql("adjudicated", "SELECT file_fingerprint, 'ADJUDICATION' AS stage_name, promote_status AS stage_status, status_reason, cnt_row_bronze AS cnt_row_written FROM v_adjudicated"))
def finalize_log(spark, sf_dir):
    return stages.run_finalize(v.inventory(spark, sf_dir), v.NOW).file_log.select("file_fingerprint", "stage_name", "stage_status", "status_reason", "cnt_row_written")
