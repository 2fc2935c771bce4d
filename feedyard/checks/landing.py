"""Paths, fingerprints, filenames, selection, classification and packing."""
from __future__ import annotations

from pyspark.sql import functions as F

from feedyard.checks import views as v
from feedyard.functions import paths, requests
from feedyard.functions.fingerprints import enrich_listing
from feedyard.operators import batching, selectors, waterfall

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


def _raw():
    """Raw paths in every form the functions tell apart."""
    return F.element_at(F.array(
        F.concat(F.lit("  dbfs:/Volumes/a/"), "l_orderkey", F.lit("/ ")), F.concat(F.lit("S3A://b/"), "l_orderkey"),
        F.concat(F.lit("/Volumes/a/"), "l_orderkey", F.lit("//")), F.concat(F.lit("f"), "l_orderkey", F.lit(".txt")),
        F.concat(F.lit("tmp/"), "l_orderkey"), F.concat(F.lit("dbfs:/mnt/"), "l_orderkey"), F.concat(F.lit("/dbfs/mnt/"), "l_orderkey"),
    ), F.pmod("l_partkey", F.lit(7)).cast("int") + 1)


_RAW_SQL = """v_raw AS (SELECT *, CASE l_partkey % 7 WHEN 0 THEN '  dbfs:/Volumes/a/' || l_orderkey || '/ ' WHEN 1 THEN 'S3A://b/' || l_orderkey
  WHEN 2 THEN '/Volumes/a/' || l_orderkey || '//' WHEN 3 THEN 'f' || l_orderkey || '.txt' WHEN 4 THEN 'tmp/' || l_orderkey
  WHEN 5 THEN 'dbfs:/mnt/' || l_orderkey ELSE '/dbfs/mnt/' || l_orderkey END AS raw FROM lineitem)"""


@query(v.sql("", """
SELECT raw, CASE WHEN l_partkey % 7 = 2 THEN 'dbfs:' || trim(raw) WHEN l_partkey % 7 = 3 THEN 's3://in/' || raw ELSE trim(raw) END AS normalized,
  rtrim(CASE WHEN l_partkey % 7 = 2 THEN 'dbfs:' || trim(raw) ELSE trim(raw) END, '/') AS print_path,
  rtrim(CASE WHEN l_partkey % 7 IN (0, 1, 5) THEN trim(raw) ELSE 'dbfs:' || trim(raw) END, '/') AS prefix
FROM v_raw""", _RAW_SQL))
def normalize_path(spark, sf_dir):
    rows = v.table(spark, sf_dir, "lineitem").withColumn("raw", _raw())
    return rows.select("raw", paths.normalize_path(F.col("raw"), F.lit("s3://in")).alias("normalized"),
                       paths.fingerprint_path(F.col("raw")).alias("print_path"), paths.source_dir_prefix(F.col("raw")).alias("prefix"))


@query(v.sql("", """
SELECT raw, CASE l_partkey % 7 WHEN 0 THEN substr(trim(raw), 6) WHEN 5 THEN '/dbfs/mnt/' || l_orderkey ELSE trim(raw) END AS local_form,
  CASE l_partkey % 7 WHEN 2 THEN 'dbfs:' || raw WHEN 6 THEN 'dbfs:/mnt/' || l_orderkey ELSE trim(raw) END AS uri_form
FROM v_raw""", _RAW_SQL))
def path_forms(spark, sf_dir):
    rows = v.table(spark, sf_dir, "lineitem").withColumn("raw", _raw())
    return rows.select("raw", paths.to_local_form(F.col("raw")).alias("local_form"), paths.to_uri_form(F.col("raw")).alias("uri_form"))


@query(v.sql("raw_config", """
SELECT row_no, CASE WHEN trim(src_uri) <> '' THEN trim(src_uri) ELSE '/Volumes/main/landing/' || tgt_bronze_table || '/' || src_subdir END AS uc_source_dir
FROM v_raw_config"""))
def source_dir(spark, sf_dir):
    return v.raw_config(spark, sf_dir).select("row_no", paths.source_dir(
        "/Volumes/main/landing", F.col("src_uri"), F.col("tgt_bronze_table"), F.col("src_subdir")).alias("uc_source_dir"))


@query(v.sql("files", "SELECT file_path, size AS src_size, mtime AS src_mtime_ms, file_fingerprint FROM v_files"))
def fingerprint(spark, sf_dir):
    return enrich_listing(v.files(spark, sf_dir)).select("file_path", "src_size", "src_mtime_ms", "file_fingerprint")


@query("""
SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_id WHEN event_id % 2 > 0 THEN user_id END AS src_size,
  CASE WHEN event_id % 5 > 0 THEN user_id END AS src_mtime_ms,
  sha256('dbfs:/Volumes/u/' || user_id || '|' || coalesce((CASE WHEN event_id % 3 > 0 THEN event_id WHEN event_id % 2 > 0 THEN user_id END)::VARCHAR, 'none')
    || '|' || coalesce((CASE WHEN event_id % 5 > 0 THEN user_id END)::VARCHAR, 'none')) AS file_fingerprint
FROM events""")
def enrich_listing_gaps(spark, sf_dir):
    """Sizes and times that are missing, text or not a number at all."""
    ev = v.table(spark, sf_dir, "events")
    rows = ev.select(
        "event_id", F.concat(F.lit("/Volumes/u/"), "user_id", F.lit("/")).alias("file_path"),
        F.when(F.pmod("event_id", F.lit(3)) > 0, F.col("event_id").cast("string")).alias("size"),
        F.when(F.pmod("event_id", F.lit(2)) > 0, F.col("user_id").cast("string")).otherwise("n/a").alias("file_size"),
        F.when(F.pmod("event_id", F.lit(5)) > 0, F.col("user_id").cast("string")).otherwise("unknown").alias("modificationTime"))
    return enrich_listing(rows).select("event_id", "src_size", "src_mtime_ms", "file_fingerprint")


_META = ("file_path, parse_status, parse_reason, vendor_code, lob_code, file_date, file_part_seq, file_part_tot, "
         "file_version_label, file_version_rank, file_extension")


@query(v.sql("files", f"SELECT {_META} FROM v_files"))
def parse_filename(spark, sf_dir):
    return v.parsed_files(spark, sf_dir).select(*_META.split(", "))


@query(v.sql("files", "SELECT file_version_label, file_version_rank, count(*) AS cnt FROM v_files WHERE parse_status = 'PARSED' GROUP BY 1, 2"))
def version_rank(spark, sf_dir):
    return v.parsed_files(spark, sf_dir).filter("parse_status = 'PARSED'").groupBy("file_version_label", "file_version_rank").agg(
        F.count(F.lit(1)).alias("cnt"))


@query(v.sql("files", "SELECT file_path, delivery_group_key, part_group_key FROM v_files"))
def group_keys(spark, sf_dir):
    return v.parsed_files(spark, sf_dir).select("file_path", "delivery_group_key", "part_group_key")


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'INCREMENTAL' WHEN 'view' THEN 'BACKFILL' WHEN 'error' THEN 'ADHOC' WHEN 'signup' THEN NULL ELSE 'REPLAY' END AS request_type,
  event_type = 'view' AND user_id % 2 = 0 AS force_reprocess,
  CASE event_type WHEN 'signup' THEN 'request_json must be a JSON object' WHEN 'purchase' THEN 'Unsupported request_type: REPLAY'
    WHEN 'view' THEN CASE WHEN user_id % 3 = 0 THEN 'BACKFILL with FILE_DATE requires file_date_from and file_date_to' END END AS request_error,
  CASE WHEN event_type = 'view' AND user_id % 3 > 0 THEN DATE '2026-01-01' + (user_id % 28)::INT END AS date_from,
  CASE WHEN event_type = 'error' THEN 'a' || user_id || ',b' END AS paths
FROM events""")
def parse_request(spark, sf_dir):
    ev = v.table(spark, sf_dir, "events")
    u = F.col("user_id")
    view = F.concat(
        F.lit('{"request_type":"backfill","selector_type":"FILE_DATE","force_reprocess":"'), F.when(F.pmod(u, F.lit(2)) == 0, " yes").otherwise("no"),
        F.when(F.pmod(u, F.lit(3)) > 0, F.concat(
            F.lit('","file_date_to":"2026-05-31","file_date_from":"'), F.date_add(F.lit("2026-01-01").cast("date"), F.pmod(u, F.lit(28)).cast("int")).cast("string"))).otherwise(""),
        F.lit('"}'))
    json = (F.when(F.col("event_type") == "click", "  ").when(F.col("event_type") == "view", view)
            .when(F.col("event_type") == "error", F.concat(F.lit('{"request_type":"ADHOC","file_paths":["a'), u, F.lit('","b"]}')))
            .when(F.col("event_type") == "signup", "[1, 2]").otherwise('{"request_type":"replay"}'))
    out = requests.parse_request(ev.withColumn("request_json", json))
    return out.select("event_id", "request_type", "force_reprocess", "request_error", "date_from", F.array_join("request_paths", ",").alias("paths"))


def _requests(spark, sf_dir, json):
    """One request per feed."""
    base = v.feeds(spark, sf_dir).select(
        "feed_key", F.concat(F.lit("req_"), "feed_key").alias("request_id"), F.concat(F.lit(v.ROOT + "/"), "feed_key", F.lit("/source")).alias("source_dir"))
    return requests.parse_request(base.withColumn("request_json", json))


@query(v.sql("files", "SELECT DISTINCT feed_key, 'req_' || feed_key AS request_id, file_path FROM v_files"))
def select_adhoc(spark, sf_dir):
    """Each file asked for by its bare name, one request per file, as an upstream system would."""
    files = v.files(spark, sf_dir)
    asked = files.select(
        "feed_key", F.concat(F.lit("req_"), "feed_key").alias("request_id"),
        F.concat(F.lit(v.ROOT + "/"), "feed_key", F.lit("/source")).alias("source_dir"), F.array("file_name").alias("request_paths"))
    return selectors.select_explicit(asked)


@query(v.sql("listing", "SELECT feed_key, 'req_' || feed_key AS request_id, file_path FROM v_listing"))
def select_discovery(spark, sf_dir):
    return selectors.select_discovery(_requests(spark, sf_dir, F.lit('{"request_type":"DISCOVERY"}')), v.listing(spark, sf_dir))


@query(v.sql("files", "SELECT file_path, file_date FROM v_files WHERE file_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'"))
def select_backfill_date(spark, sf_dir):
    return selectors.by_file_date(v.parsed_files(spark, sf_dir), "1996-01-01", "1997-06-30").select("file_path", "file_date")


@query(v.sql("files", "SELECT file_path, mtime AS src_mtime_ms FROM v_files WHERE mtime BETWEEN epoch_ms(TIMESTAMP '1996-01-01 03:00:00') AND epoch_ms(TIMESTAMP '1997-06-30 04:00:00')"))
def select_backfill_mtime(spark, sf_dir):
    return selectors.by_mtime(v.parsed_files(spark, sf_dir), "1996-01-01T03:00:00Z", "1997-06-30 04:00:00").select("file_path", "src_mtime_ms")


@query(v.sql("files", "SELECT file_path, file_date FROM v_files WHERE file_date BETWEEN DATE '1998-12-01' - 200 AND DATE '1998-12-01'"))
def select_incr_date(spark, sf_dir):
    return selectors.incremental_by_date(v.parsed_files(spark, sf_dir), v.NOW, 200 * 1440).select("file_path", "file_date")


@query(v.sql("files", f"SELECT file_path, mtime AS src_mtime_ms FROM v_files WHERE mtime >= epoch_ms(TIMESTAMP '{v.NOW}' - INTERVAL 1440 MINUTE)"))
def select_incr_mtime(spark, sf_dir):
    return selectors.incremental_by_mtime(v.parsed_files(spark, sf_dir), v.NOW, 1440).select("file_path", "src_mtime_ms")


@query(v.sql("files feeds", f"""
SELECT f.feed_key, 'req_' || f.feed_key AS request_id, f.file_path FROM v_files f JOIN v_feeds c ON f.feed_key = c.feed_key
WHERE CASE fn % 5
  WHEN 0 THEN CASE WHEN fn % 2 = 0 THEN file_date BETWEEN DATE '1998-12-01' - (CASE WHEN fn = 0 THEN 1 ELSE fn * 30 END) AND DATE '1998-12-01'
              ELSE mtime >= epoch_ms(TIMESTAMP '{v.NOW}') - fn * 30 * 86400000::BIGINT END
  WHEN 1 THEN mtime >= epoch_ms(TIMESTAMP '{v.NOW}') - 90 * 60000
  WHEN 2 THEN file_date BETWEEN DATE '1996-02-01' AND DATE '1996-12-31'
  WHEN 3 THEN mtime BETWEEN epoch_ms(TIMESTAMP '1997-01-01') AND epoch_ms(TIMESTAMP '1997-03-01')
  ELSE true END"""))
def select_paths(spark, sf_dir):
    """All request types side by side, one per feed."""
    n = F.regexp_extract("feed_key", r"\d+", 0).cast("int")
    json = F.element_at(F.array(
        F.lit(""), F.lit('{"request_type":"INCREMENTAL","selector_type":"file_modified_ts","lookback_minutes":90}'),
        F.lit('{"request_type":"BACKFILL","file_date_from":"1996-02-01","file_date_to":"1996-12-31"}'),
        F.lit('{"request_type":"BACKFILL","selector_type":"FILE_MODIFIED_TS","modified_from_ts":"1997-01-01T00:00:00Z","modified_to_ts":"1997-03-01"}'),
        F.lit('{"request_type":"DISCOVERY"}')), F.pmod(n, F.lit(5)) + 1)
    return selectors.select_paths(_requests(spark, sf_dir, json), v.parsed_files(spark, sf_dir), v.feeds(spark, sf_dir), v.NOW)


@query(v.sql("event_log", """
SELECT identity, event_id, stage_name, stage_status, ts_event FROM (
  SELECT *, row_number() OVER (PARTITION BY identity ORDER BY ts_event DESC, event_id DESC) AS rn
  FROM (SELECT *, CASE WHEN file_fingerprint = '' THEN file_path ELSE file_fingerprint END AS identity FROM v_event_log)) WHERE rn = 1"""))
def latest_by_identity(spark, sf_dir):
    return waterfall.latest_by_identity(v.event_log(spark, sf_dir)).select("identity", "event_id", "stage_name", "stage_status", "ts_event")


_BLOCKED_SQL = """v_blocked AS (
  SELECT identity FROM (
    SELECT identity, stage_status, row_number() OVER (PARTITION BY identity ORDER BY ts_event DESC, event_id DESC) AS rn
    FROM (SELECT *, CASE WHEN file_fingerprint = '' THEN file_path ELSE file_fingerprint END AS identity FROM v_ingest_log
          WHERE ts_event >= TIMESTAMP '1998-12-01' - INTERVAL 8640 HOUR))
  WHERE rn = 1 AND stage_status = 'STARTED')"""


@query(v.sql("ingest_log", "SELECT identity FROM v_blocked", _BLOCKED_SQL))
def blocked_recent(spark, sf_dir):
    return waterfall.blocked_identities(v.ingest_log(spark, sf_dir), v.NOW, 8640)


@query(v.sql("known", "SELECT DISTINCT file_fingerprint FROM v_known WHERE load_status = 'LOADED_BRONZE'"))
def already_done(spark, sf_dir):
    return waterfall.already_done(v.known_inventory(spark, sf_dir))


def _flags(spark, sf_dir):
    """Every file ever dropped is asked for; odd feeds force a reload."""
    asked = v.files(spark, sf_dir).select(
        "feed_key", F.concat(F.lit("req_"), "feed_key").alias("request_id"), "file_path",
        (F.pmod("l_orderkey", F.lit(2)) == 1).alias("force_reprocess"))
    return waterfall.classify(asked, v.arrived(v.listed_files(spark, sf_dir)), v.feeds(spark, sf_dir), v.known_inventory(spark, sf_dir),
                              waterfall.blocked_identities(v.ingest_log(spark, sf_dir), v.NOW, 8640))


_FLAGS_SQL = _BLOCKED_SQL + """,
v_base AS (
  SELECT f.feed_key, 'req_' || f.feed_key AS request_id, f.file_path, f.size, f.o % 2 = 1 AS force, NOT f.bad AS pattern_valid,
    l.file_path IS NOT NULL AS exists_in_source, f.file_fingerprint AS listed_print, f.file_name,
    NOT f.bad AND l.file_path IS NOT NULL AS ready
  FROM v_files f LEFT JOIN v_listing l ON f.file_path = l.file_path),
v_marks AS (
  SELECT *, ready AND file_path IN (SELECT file_path FROM v_known) AS in_inventory,
    ready AND (file_path IN (SELECT identity FROM v_blocked) OR listed_print IN (SELECT identity FROM v_blocked)) AS blocked_recent,
    ready AND listed_print IN (SELECT file_fingerprint FROM v_known WHERE load_status = 'LOADED_BRONZE') AS already_done
  FROM v_base),
v_flags AS (
  SELECT *, ready AND NOT blocked_recent AND (force OR NOT already_done) AS final_eligible FROM v_marks)"""
_FLAG_VIEWS = "listing known ingest_log"
_FLAG_COLS = "feed_key, request_id, file_path, pattern_valid, exists_in_source, in_inventory, blocked_recent, already_done, ready, final_eligible"


@query(v.sql(_FLAG_VIEWS, f"SELECT {_FLAG_COLS} FROM v_flags", _FLAGS_SQL))
def waterfall_flags(spark, sf_dir):
    return _flags(spark, sf_dir).select(*_FLAG_COLS.split(", "))


@query(v.sql(_FLAG_VIEWS, """
SELECT file_path, CASE WHEN final_eligible THEN 'request path is eligible' WHEN blocked_recent THEN 'blocked by recent in-progress status'
  WHEN already_done THEN 'already bronze loaded; use force_reprocess to override' ELSE 'request path is rejected' END AS status_reason
FROM v_flags""", _FLAGS_SQL))
def reject_reasons(spark, sf_dir):
    return _flags(spark, sf_dir).select("file_path", "status_reason")


_LISTS_SQL = " UNION ALL ".join(
    f"SELECT feed_key, request_id, file_path, '{name}' AS list_name FROM v_flags WHERE {'true' if cond == 'requested' else cond}"
    for name, cond in waterfall.PATH_LISTS.items())


@query(v.sql(_FLAG_VIEWS, f"""
SELECT feed_key, request_id, list_name, ((rn - 1) // 500)::INT AS chunk_no, string_agg(file_path, ',' ORDER BY file_path) AS paths
FROM (SELECT *, row_number() OVER (PARTITION BY feed_key, request_id, list_name ORDER BY file_path) AS rn FROM ({_LISTS_SQL}))
GROUP BY 1, 2, 3, 4""", _FLAGS_SQL))
def waterfall_arrays(spark, sf_dir):
    return waterfall.path_lists(_flags(spark, sf_dir), 500).withColumn("paths", F.array_join("paths", ","))


@query(v.sql(_FLAG_VIEWS, "SELECT feed_key, request_id, " + ", ".join(
    f"count(*) FILTER ({'true' if cond == 'requested' else cond}) AS {name.replace('arr_paths_', 'cnt_')}" for name, cond in waterfall.PATH_LISTS.items())
    + " FROM v_flags GROUP BY 1, 2", _FLAGS_SQL))
def request_summary(spark, sf_dir):
    return waterfall.request_summary(_flags(spark, sf_dir))


def _batches(spark, sf_dir):
    files = v.listed_files(spark, sf_dir).select("feed_key", "file_path", "size", "file_fingerprint")
    limits = v.feeds(spark, sf_dir).select("feed_key", "batch_max_files", "batch_max_bytes")
    return batching.pack_batches(files.join(limits, "feed_key"), F.col("batch_max_files"), F.col("batch_max_bytes"), chunk=1000)


_PACK_SQL = """v_lim AS (SELECT feed_key, 2 + fn % 9 AS max_files, 5000000::BIGINT * (1 + fn % 4) AS max_bytes FROM v_feeds),
v_seq AS (SELECT f.feed_key, f.file_path, f.file_fingerprint, f.size, l.max_files, l.max_bytes,
    row_number() OVER (PARTITION BY f.feed_key ORDER BY f.file_path) AS rn FROM v_files f JOIN v_lim l ON f.feed_key = l.feed_key),
v_pack AS (
  SELECT feed_key, rn, 1::BIGINT AS batch_no, 1::BIGINT AS cnt, size AS bytes FROM v_seq WHERE rn = 1
  UNION ALL
  SELECT s.feed_key, s.rn, p.batch_no + (CASE WHEN p.cnt >= s.max_files OR p.bytes + s.size > s.max_bytes THEN 1 ELSE 0 END),
    CASE WHEN p.cnt >= s.max_files OR p.bytes + s.size > s.max_bytes THEN 1 ELSE p.cnt + 1 END,
    CASE WHEN p.cnt >= s.max_files OR p.bytes + s.size > s.max_bytes THEN s.size ELSE p.bytes + s.size END
  FROM v_pack p JOIN v_seq s ON s.feed_key = p.feed_key AND s.rn = p.rn + 1),
v_batches AS (
  SELECT feed_key, batch_no, 'batch_' || (CASE WHEN batch_no < 100 THEN lpad(batch_no::VARCHAR, 3, '0') ELSE batch_no::VARCHAR END) AS batch_id,
    count(*)::INT AS file_count, sum(size)::BIGINT AS total_size_bytes, min(file_path) AS first_path, max(file_path) AS last_path
  FROM v_pack JOIN v_seq USING (feed_key, rn) GROUP BY 1, 2)"""


@query(v.sql("files feeds", "SELECT feed_key, batch_no, batch_id, file_count, total_size_bytes, first_path, last_path FROM v_batches", _PACK_SQL))
def pack_batches(spark, sf_dir):
    refs = batching.read_refs(F.col("batch_file_paths_json"))
    return _batches(spark, sf_dir).select(
        "feed_key", "batch_no", "batch_id", "file_count", "total_size_bytes", F.array_min(F.transform(refs, lambda r: r.path)).alias("first_path"),
        F.array_max(F.transform(refs, lambda r: r.path)).alias("last_path"))


@query(v.sql("files feeds", """
SELECT feed_key, count(*) AS batches, count(*) FILTER (batch_no <= 20) AS in_run,
  coalesce(sum(file_count) FILTER (batch_no > 20), 0)::BIGINT AS deferred_files FROM v_batches GROUP BY 1""", _PACK_SQL))
def batch_cap(spark, sf_dir):
    return batching.cap_batches(_batches(spark, sf_dir), 20).groupBy("feed_key").agg(
        F.count(F.lit(1)).alias("batches"), F.count_if("in_run").alias("in_run"),
        F.coalesce(F.sum(F.when(~F.col("in_run"), F.col("file_count"))), F.lit(0)).alias("deferred_files"))


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'p' || event_id ELSE 'p' || user_id END AS path,
  CASE event_id % 3 WHEN 0 THEN 'fp_' || user_id WHEN 1 THEN NULL END AS fingerprint FROM events""")
def batch_refs(spark, sf_dir):
    ev = v.table(spark, sf_dir, "events")
    u, e = F.col("user_id"), F.col("event_id")
    json = (F.when(F.pmod(e, F.lit(3)) == 0, F.concat(F.lit('[{"path":"p'), u, F.lit('","fingerprint":"fp_'), u, F.lit(' "}]')))
            .when(F.pmod(e, F.lit(3)) == 1, F.concat(F.lit('[{"file_path":"p'), u, F.lit('","file_fingerprint":"  "}]')))
            .otherwise(F.concat(F.lit('["p'), e, F.lit('"]'))))
    return ev.select("event_id", F.explode(batching.read_refs(json)).alias("r")).select("event_id", "r.path", "r.fingerprint")
