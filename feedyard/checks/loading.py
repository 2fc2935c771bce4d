"""Listing, reading and loading files written from the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from feedyard.checks import dropzone, views as v
from feedyard.functions.fingerprints import enrich_listing
from feedyard.functions.paths import base_name
from feedyard.functions.requests import parse_request
from feedyard.operators import bronze, config_sync, drift, logs, selectors, waterfall
from feedyard.plans import ingest as plan
from feedyard.session import stable, work_dir
from feedyard.sources import archives, configs, delimited, listing
from feedyard.sources.listing import list_files as list_dir

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


_CUST = """v_cust AS (
  SELECT c_custkey, c_custkey // 50 AS chunk, ((c_custkey // 50) % 3)::INT AS kind, c_custkey::VARCHAR AS custkey, c_name AS name,
    CASE WHEN (c_custkey // 50) % 3 <> 1 THEN c_nationkey::VARCHAR END AS nation,
    CASE (c_custkey // 50) % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_mktsegment || '|x' END AS segment,
    CASE WHEN (c_custkey // 50) % 3 = 2 THEN 'e' || c_nationkey END AS de,
    CASE (c_custkey // 50) % 3 WHEN 0 THEN 'custkey|name|nation|segment' WHEN 1 THEN 'custkey|segment|name' ELSE ' custkey | name|nation|d.e' END AS header,
    CASE (c_custkey // 50) % 3 WHEN 0 THEN concat_ws('|', c_custkey, c_name, c_nationkey, c_mktsegment)
      WHEN 1 THEN concat_ws('|', c_custkey, '"' || c_mktsegment || '|x"', c_name) ELSE concat_ws('|', c_custkey, c_name, c_nationkey, 'e' || c_nationkey) END AS line
  FROM customer)"""


@query(v.sql("", "SELECT 'customers_' || chunk || '.txt' AS file_name, (sum(length(line) + 1) + max(length(header)) + 1)::BIGINT AS size FROM v_cust GROUP BY 1", _CUST))
def list_files(spark, sf_dir):
    return list_dir(spark, dropzone.dropped(spark, sf_dir)).select("file_name", "size")


_ANY = "['', '_', '.'][chunk // 3 % 3 + 1] || 'customers_' || chunk || '.txt'"


@query(v.sql("", f"SELECT {_ANY} AS file_name, (sum(length(line) + 1) + max(length(header)) + 1)::BIGINT AS size FROM v_cust GROUP BY 1", _CUST))
def list_all_names(spark, sf_dir):
    """Names that begin with an underscore or a dot are deliveries like any other."""
    return list_dir(spark, dropzone.dropped(spark, sf_dir, prefixed=True)).select("file_name", "size")


@query(v.sql("", "SELECT DISTINCT 'customers_' || chunk || '.txt' AS file_name, header AS first_line, replace(replace(header, '|', ','), ' ', '') AS column_list FROM v_cust", _CUST))
def read_headers(spark, sf_dir):
    heads = delimited.read_headers(list_dir(spark, dropzone.dropped(spark, sf_dir)), "|")
    return heads.select(base_name(F.col("file_path")).alias("file_name"), "first_line", F.array_join("columns", ",").alias("column_list"))


def _feed():
    return plan.Feed("customers", dropzone.FEED_REGEX, dropzone.FEED_SPEC)


def _ingest(spark, sf_dir, zipped=False):
    listed = enrich_listing(list_dir(spark, dropzone.dropped(spark, sf_dir, zipped))).select("file_path", "file_name", "file_fingerprint")
    return plan.read_batch(spark, _feed(), listed, "batch_001", "req_1", "run_1", v.NOW)


def _report(spark, sf_dir):
    batch = _ingest(spark, sf_dir)
    return plan.report(_feed(), batch, bronze.bronze_counts(batch.rows), ["custkey", "name", "nation", "segment"], "bronze_customers",
                       "batch_001", "req_1", "run_1", v.NOW)


_ROWS = "SELECT custkey, name, nation, segment, de, 'customers_' || chunk || '.txt' AS src_file_name FROM v_cust"


@query(v.sql("", "SELECT custkey, name, nation, segment FROM v_cust WHERE kind = 0 UNION ALL SELECT custkey, name, NULL, segment FROM v_cust WHERE kind = 1 "
             "UNION ALL SELECT custkey, name, nation, NULL FROM v_cust WHERE kind = 2", _CUST))
def scan_delimited(spark, sf_dir):
    """One scan per header, columns by name, all text."""
    heads = delimited.read_headers(list_dir(spark, dropzone.dropped(spark, sf_dir)), "|")
    parts = plan._plain_rows(spark, heads, _feed())
    return plan._unite(parts).select("custkey", "name", "nation", "segment")


@query(v.sql("", "SELECT 'customers_' || chunk || '.zip' AS file_name, 'inner/m_' || chunk || '.TXT' AS member, "
             "row_number() OVER (PARTITION BY chunk ORDER BY c_custkey) + 1 AS line_no, line FROM v_cust UNION ALL "
             "SELECT DISTINCT 'customers_' || chunk || '.zip', 'inner/m_' || chunk || '.TXT', 1, header FROM v_cust", _CUST))
def scan_zip(spark, sf_dir):
    lines = archives.scan_zip(list_dir(spark, dropzone.dropped(spark, sf_dir, zipped=True)))
    return lines.select(base_name(F.col("file_path")).alias("file_name"), "member", "line_no", "line")


@query(v.sql("", "SELECT DISTINCT kind, replace(replace(header, '|', ','), ' ', '') AS column_list FROM v_cust", _CUST))
def schema_seed(spark, sf_dir):
    """The seed of each kind of file: that of its first file, all seeds being read in one pass."""
    seeds = delimited.schema_seeds(list_dir(spark, dropzone.dropped(spark, sf_dir)), "|")
    chunk = F.regexp_extract(base_name(F.col("file_path")), r"_(\d+)\.", 1).cast("int")
    kind = F.pmod(chunk, F.lit(3)).alias("kind")
    return seeds.groupBy(kind).agg(F.array_join(F.min_by("columns", chunk), ",").alias("column_list"))


@query(v.sql("", "SELECT custkey, (row_number() OVER (PARTITION BY chunk ORDER BY c_custkey) + 1)::BIGINT AS src_row_number FROM v_cust", _CUST))
def src_row_number(spark, sf_dir):
    heads = delimited.read_headers(list_dir(spark, dropzone.dropped(spark, sf_dir)), "|")
    return delimited.number_lines(plan._unite(plan._plain_rows(spark, heads, _feed())), True).select("custkey", "src_row_number")


@query(v.sql("raw_config", "SELECT feed_key, ctl_active, trim(src_uri) AS src_uri, tgt_bronze_table, CASE WHEN batch_max_files = '' THEN 10 ELSE batch_max_files::INT END AS batch_max_files, "
             "CASE WHEN sched_timezone = '' THEN 'UTC' ELSE sched_timezone END AS sched_timezone FROM v_raw_config WHERE trim(feed_key) <> ''"))
def config_scan(spark, sf_dir):
    """Suppliers' configuration written as CSV files and scanned back."""
    folder = work_dir(spark, "cfg")
    raw = v.raw_config(spark, sf_dir).drop("config_source_file", "config_source_mtime", "row_no")
    raw.write.option("header", True).option("escape", '"').csv(folder)
    return config_sync.fill_defaults(configs.scan_config(spark, folder)).select(
        "feed_key", "ctl_active", "src_uri", "tgt_bronze_table", "batch_max_files", "sched_timezone")


@query(v.sql("", _ROWS + " ORDER BY ALL", _CUST))
def ingest_batch(spark, sf_dir):
    rows = _ingest(spark, sf_dir).rows
    return rows.select("custkey", "name", "nation", "segment", F.col("`d.e`").alias("de"), "src_file_name")


@query(v.sql("", _ROWS.replace("'customers_' || chunk || '.txt'", _ANY), _CUST))
def ingest_all_names(spark, sf_dir):
    """Files of every name are asked for by path, found in the listing, and loaded."""
    folder = dropzone.dropped(spark, sf_dir, prefixed=True)
    listed = enrich_listing(list_dir(spark, folder)).withColumn("feed_key", F.lit("customers"))
    asked = listed.groupBy("feed_key", F.concat(F.lit("req_"), F.crc32(F.col("file_name").cast("binary")) % 4).alias("request_id")).agg(
        F.to_json(F.struct(F.lit("ADHOC").alias("request_type"), F.collect_list("file_name").alias("file_paths"))).alias("request_json"))
    paths = selectors.select_explicit(parse_request(asked).withColumn("source_dir", F.lit(listing.qualified(spark, folder))))
    refs = paths.join(listed, ["feed_key", "file_path"]).select("file_path", "file_name", "file_fingerprint")
    rows = plan.read_batch(spark, plan.Feed("customers", dropzone.ANY_REGEX, dropzone.FEED_SPEC), refs, "batch_001", "req_1", "run_1", v.NOW).rows
    return rows.select("custkey", "name", "nation", "segment", F.col("`d.e`").alias("de"), "src_file_name")


@query(v.sql("", _ROWS.replace(".txt", ".zip"), _CUST))
def ingest_zip(spark, sf_dir):
    rows = _ingest(spark, sf_dir, zipped=True).rows
    return rows.select("custkey", "name", "nation", "segment", F.col("`d.e`").alias("de"), "src_file_name")


@query(v.sql("", """SELECT 'customers_' || chunk || '.zip' AS file_name, CASE WHEN chunk % 5 IN (1, 2) THEN 'FAILED' ELSE 'SUCCEEDED' END AS stage_status,
  CASE WHEN chunk % 5 NOT IN (1, 2) THEN count(*) END AS cnt, CASE WHEN chunk % 5 IN (1, 2) THEN 0 ELSE count(*) END AS rows_held FROM v_cust GROUP BY chunk""", _CUST))
def ingest_bad_archives(spark, sf_dir):
    """Damaged and encrypted archives fail by themselves; all others of the load are loaded."""
    refs = enrich_listing(list_dir(spark, dropzone.dropped(spark, sf_dir, zipped=True, spoilt=True)))
    table, log = work_dir(spark, "bronze"), work_dir(spark, "logs")
    plan.load(spark, _feed(), refs, table, log, "batch_001", "req_1", "run_1", v.NOW)
    held = bronze.read_bronze(spark, table).groupBy(F.col("src_file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows_held"))
    ended = logs.read_log(spark, f"{log}/file_log", table).filter("stage_name = 'INGEST_CONTROL' AND stage_status <> 'STARTED'")
    return ended.join(held, "file_name", "left").select("file_name", "stage_status", F.col("cnt_row_written").alias("cnt"), F.coalesce("rows_held", F.lit(0)).alias("rows_held"))


@query(v.sql("", f"SELECT DISTINCT 'customers' AS feed_key, 'req_1' AS request_id, 'run_1' AS dispatch_run_id, 'customers_' || chunk || '.txt' AS src_file_name, "
             f"64 AS fp_len, TIMESTAMP '{v.NOW}' AS ts_ingest FROM v_cust", _CUST))
def bronze_lineage(spark, sf_dir):
    rows = _ingest(spark, sf_dir).rows
    return rows.select("feed_key", "request_id", "dispatch_run_id", "src_file_name", F.length("src_file_fingerprint").alias("fp_len"), "ts_ingest").distinct()


@query(v.sql("", """SELECT file_name, stage_name, stage_status, status_reason, cnt FROM (
  SELECT 'customers_' || chunk || '.txt' AS file_name, count(*) AS n FROM v_cust GROUP BY 1),
  LATERAL (VALUES ('INGEST_CONTROL', 'STARTED', 'batch_id=batch_001; ingest started', NULL), ('INGEST_CONTROL', 'SUCCEEDED', 'batch_id=batch_001; ingest completed', n),
                  ('BRONZE_LOAD', 'SUCCEEDED', 'bronze load succeeded', n)) s(stage_name, stage_status, status_reason, cnt)""", _CUST))
def ingest_log(spark, sf_dir):
    refs = enrich_listing(list_dir(spark, dropzone.dropped(spark, sf_dir))).select("file_path", "file_name", "file_fingerprint")
    log = plan.start_log(_feed(), refs, "batch_001", "req_1", "run_1", v.NOW).unionByName(_report(spark, sf_dir).file_log)
    return log.select("file_name", "stage_name", "stage_status", "status_reason", F.col("cnt_row_written").alias("cnt"))


@query(v.sql("", "SELECT DISTINCT 'customers_' || chunk || '.txt' AS file_name, CASE kind WHEN 0 THEN 'N' ELSE 'Y' END AS change_detected, "
             "CASE kind WHEN 0 THEN 'source columns match target schema' WHEN 1 THEN 'missing_in_file=nation' ELSE 'missing_in_file=segment; new_in_file=d.e' END AS status_reason FROM v_cust", _CUST))
def ingest_drift(spark, sf_dir):
    return _report(spark, sf_dir).schema_changes.select("file_name", "change_detected", "status_reason")


@query(v.sql("", """SELECT DISTINCT 'WARNING' AS severity, 'SCHEMA' AS category, 'SCHEMA_DRIFT_DETECTED' AS event_type,
  'Schema drift in customers_' || chunk || '.txt vs bronze_customers: ' || CASE kind WHEN 1 THEN 'missing_in_file=nation' ELSE 'missing_in_file=segment; new_in_file=d.e' END AS message
FROM v_cust WHERE kind > 0""", _CUST))
def drift_notifications(spark, sf_dir):
    return _report(spark, sf_dir).notifications.select("severity", "category", "event_type", "message")


@query(v.sql("", "SELECT custkey, name, nation, segment, de FROM v_cust UNION ALL SELECT custkey, name, nation, NULL, de FROM v_cust", _CUST))
def bronze_append(spark, sf_dir):
    """Two appends of different width, read back as one table."""
    path = work_dir(spark, "bronze")
    rows = _ingest(spark, sf_dir).rows
    bronze.append_bronze(rows, path)
    bronze.append_bronze(rows.drop("segment"), path)
    return bronze.read_bronze(spark, path).select("custkey", "name", "nation", "segment", F.col("`d.e`").alias("de"))


@query(v.sql("", """SELECT file_name, load_no, n AS cnt, CASE WHEN chunk % 2 = 1 THEN 'STARTED' ELSE 'ENDED' END AS state, chunk % 2 = 1 AS blocked, chunk % 2 = 0 AS loaded
FROM (SELECT chunk, 'customers_' || chunk || '.txt' AS file_name, count(*) AS n FROM v_cust GROUP BY 1, 2), (VALUES (1), (2)) t(load_no)""", _CUST))
def ingest_lifecycle(spark, sf_dir):
    """Files of even number are loaded twice without a request id, the others only started, as by a job that died.

    Each load counts its own rows; after it its files are free again; what only started stays blocked.
    """
    refs = stable(enrich_listing(list_dir(spark, dropzone.dropped(spark, sf_dir))).select("file_path", "file_name", "file_fingerprint"))
    even = F.pmod(F.regexp_extract("file_name", r"_(\d+)\.", 1).cast("int"), F.lit(2)) == 0
    table, log = work_dir(spark, "bronze"), work_dir(spark, "logs")
    logs.append_log(plan.start_log(_feed(), refs.filter(~even), "batch_009", None, "run_0", v.NOW), f"{log}/file_log")
    counts = None
    for n in (1, 2):
        done = plan.load(spark, _feed(), refs.filter(even), table, log, f"batch_00{n}", None, f"run_{n}", v.NOW)
        done = done.select("file_fingerprint", F.col("cnt_row_bronze").alias("cnt"), F.lit(n).alias("load_no"))
        counts = done if counts is None else counts.unionByName(done)
    blocked = waterfall.blocked_identities(logs.read_log(spark, f"{log}/file_log", table), v.NOW).select(F.col("identity").alias("file_fingerprint"), F.lit(True).alias("blocked"))
    sizes = plan.read_batch(spark, _feed(), refs, "batch_000", None, None, v.NOW).rows.groupBy(F.col("src_file_fingerprint").alias("file_fingerprint")).agg(F.count(F.lit(1)).alias("n"))
    every = refs.join(sizes, "file_fingerprint").withColumn("load_no", F.explode(F.array(F.lit(1), F.lit(2))))
    joined = every.join(counts.withColumn("loaded", F.lit(True)), ["file_fingerprint", "load_no"], "left").join(blocked, "file_fingerprint", "left")
    return joined.select("file_name", "load_no", F.coalesce("cnt", "n").alias("cnt"), F.when(F.col("blocked"), "STARTED").otherwise("ENDED").alias("state"),
                         F.coalesce("blocked", F.lit(False)).alias("blocked"), F.coalesce("loaded", F.lit(False)).alias("loaded"))


@query(v.sql("", "SELECT 'customers_' || chunk || '.txt' AS src_file_name, count(*) AS cnt_row_bronze FROM v_cust GROUP BY 1", _CUST))
def bronze_counts(spark, sf_dir):
    run = _ingest(spark, sf_dir)
    counts = bronze.bronze_counts(run.rows).withColumnRenamed("src_file_fingerprint", "file_fingerprint")
    return counts.join(run.files, "file_fingerprint").select(F.col("file_name").alias("src_file_name"), "cnt_row_bronze")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hint_' || event_id WHEN event_id % 3 = 1 THEN 'listed_' || user_id
  ELSE sha256('dbfs:/u/' || event_id || '|none|none') END AS file_fingerprint FROM events""")
def ingest_fingerprint(spark, sf_dir):
    ev = v.table(spark, sf_dir, "events")
    e = F.col("event_id")
    known = F.pmod(e, F.lit(3)) == 1
    refs = ev.select("event_id", F.concat(F.lit("dbfs:/u/"), F.when(known, F.concat(F.lit("k"), "user_id")).otherwise(e.cast("string"))).alias("file_path"),
                     F.when(F.pmod(e, F.lit(3)) == 0, F.concat(F.lit(" hint_"), e)).otherwise("").alias("fingerprint"))
    listed = ev.select(F.concat(F.lit("dbfs:/u/k"), "user_id").alias("file_path"), F.col("user_id").cast("string").alias("file_name"),
                       F.concat(F.lit("listed_"), "user_id").alias("file_fingerprint")).distinct()
    return plan.ingest_fingerprints(refs, listed).select("event_id", "file_fingerprint")


_DRIFT = """v_heads AS (SELECT p_partkey, string_split(p_name, ' ') AS src, ['red', 'bolt', 'size'] AS tgt FROM part),
v_diff AS (SELECT *, list_filter(tgt, lambda x: NOT list_contains(src, x)) AS gone, list_filter(src, lambda x: NOT list_contains(tgt, x)) AS fresh FROM v_heads)"""


@query(v.sql("", """SELECT p_partkey, 'Y' AS change_detected, array_to_string(gone, ',') AS gone, array_to_string(fresh, ',') AS fresh,
  concat_ws('; ', 'missing_in_file=' || array_to_string(gone, ','), CASE WHEN len(fresh) > 0 THEN 'new_in_file=' || array_to_string(fresh, ',') END) AS status_reason
FROM v_diff""", _DRIFT))
def schema_drift(spark, sf_dir):
    heads = v.table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("source_columns"),
                                                  F.array(F.lit("red"), F.lit("bolt"), F.lit("size")).alias("target_columns"))
    return drift.detect_drift(heads).select("p_partkey", "change_detected", F.array_join("missing_in_file", ",").alias("gone"),
                                            F.array_join("new_in_file", ",").alias("fresh"), "status_reason")


@query("SELECT s_suppkey, s_name, NULL::VARCHAR AS dispatch_run_id, NULL::BIGINT AS cnt FROM supplier")
def schema_evolve(spark, sf_dir):
    """Columns a table has in another case are not added again, blank names never."""
    s = v.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return drift.evolve(s, [("S_NAME", "string"), ("dispatch_run_id", "string"), (" ", "string"), ("cnt", "bigint"), ("CNT", "string")])


@query("SELECT p_partkey, p_name AS name, NULL::VARCHAR AS brand, NULL::VARCHAR AS extra FROM part")
def schema_policy(spark, sf_dir):
    """A seed's columns exist before any file has them."""
    rows = v.table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    return drift.evolve_business(rows, drift.initial_columns("AUTO", ["name", "brand", "extra"]) + drift.initial_columns("FIRST_FILE", ["never"]))


@query("SELECT date_trunc('month', o_orderdate)::DATE AS month_start, count(*) AS cnt, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def bronze_partition_month(spark, sf_dir):
    path = work_dir(spark, "month")
    rows = v.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    bronze.append_bronze(bronze.with_month(rows, "o_orderdate"), path, ["date_month"])
    back = spark.read.parquet(path)
    return back.groupBy(F.to_date(F.concat(F.col("date_month").cast("string"), F.lit("-01"))).alias("month_start")).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("o_orderkey").alias("keys"))


@query("SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS cnt FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1, 2")
def source_partitions(spark, sf_dir):
    """A feed laid out by year and month, read through a path template for one year."""
    from feedyard.sources.listing import template_glob
    path = work_dir(spark, "parts")
    o = v.table(spark, sf_dir, "orders")
    o.select(F.col("o_orderkey").cast("string").alias("line"), F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "MM").alias("month")).write.partitionBy("year", "month").text(path)
    glob = template_glob("year={yyyy}/month={mm}", {"yyyy": "1997"})
    rows = spark.read.option("basePath", path).text(f"{path}/{glob}")
    return rows.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count(F.lit(1)).alias("cnt"))


@query(v.sql("event_log", "SELECT event_id, feed_key, file_path, file_fingerprint, stage_name, stage_status FROM v_event_log"))
def append_log(spark, sf_dir):
    path = work_dir(spark, "log")
    rows = logs.file_log(v.event_log(spark, sf_dir), v.EVENTS_NOW)
    logs.append_log(rows, path)
    logs.append_log(rows.filter("stage_name = 'NONE'"), path)
    return logs.read_log(spark, path).select("event_id", "feed_key", "file_path", "file_fingerprint", "stage_name", "stage_status")
