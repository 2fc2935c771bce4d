"""Inventory and configuration state: discovery, load marks, adjudication, sync, evolution."""
from __future__ import annotations

from pyspark.sql import functions as F

from feedyard import schemas
from feedyard.checks import views as v
from feedyard.operators import config_sync, inventory, upsert as ups

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


_VERDICT = "file_fingerprint, flg_latest, flg_superseded, flg_legit_for_silver, promote_status, status_reason"


@query(v.sql("winners", "SELECT part_group_key, file_fingerprint, file_version_rank FROM v_ranked WHERE rn = 1"))
def version_rank_window(spark, sf_dir):
    inv = v.inventory(spark, sf_dir)
    return inventory.part_winners(inv).select("part_group_key", "file_fingerprint", "file_version_rank")


@query(v.sql("winners", "SELECT * FROM v_delivery"))
def delivery_status(spark, sf_dir):
    return inventory.delivery_status(inventory.part_winners(v.inventory(spark, sf_dir))).drop("cnt_part_groups")


@query(v.sql("adjudicated", f"SELECT {_VERDICT} FROM v_adjudicated"))
def adjudicate(spark, sf_dir):
    return inventory.adjudicate(v.inventory(spark, sf_dir)).select(*_VERDICT.split(", "))


@query(v.sql("adjudicated", f"SELECT {_VERDICT} FROM v_adjudicated"))
def adjudicate_hot_deliveries(spark, sf_dir):
    """The same verdicts with every delivery of more than one part taking the hot-key branch, the largest of them where they are too many to broadcast."""
    return inventory.adjudicate(v.inventory(spark, sf_dir), hot_rows=1).select(*_VERDICT.split(", "))


@query(v.sql("adjudicated", """
SELECT feed_key, count(*) AS inventory_row_count, count(*) FILTER (flg_latest = 'Y') AS latest_file_count,
  count(*) FILTER (flg_superseded = 'Y') AS superseded_file_count, count(*) FILTER (flg_legit_for_silver = 'Y') AS legit_file_count,
  count(*) FILTER (promote_status = 'READY_FOR_SILVER') AS ready_for_silver_count, coalesce(sum(cnt_row_bronze), 0)::BIGINT AS total_bronze_rows
FROM v_adjudicated GROUP BY 1"""))
def finalize_summary(spark, sf_dir):
    return inventory.finalize_summary(inventory.adjudicate(v.inventory(spark, sf_dir)))


@query(v.sql("inventory", """
SELECT feed_key, count(*) AS inventory_row_count, count(*) FILTER (parse_status = 'PARSED') AS parsed_file_count,
  count(*) FILTER (parse_status = 'PARSE_FAILED') AS parse_failed_file_count FROM v_inventory GROUP BY 1"""))
def manifest_summary(spark, sf_dir):
    return inventory.manifest_summary(v.inventory(spark, sf_dir))


@query(v.sql("inventory", """
SELECT feed_key, load_status, count(*) AS cnt_files FROM v_inventory
WHERE file_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1, 2"""))
def backfill_progress(spark, sf_dir):
    return inventory.backfill_progress(v.inventory(spark, sf_dir), "1996-01-01", "1998-12-31")


def _discovered(spark, sf_dir):
    listed = v.listing(spark, sf_dir)
    asked = listed.select("feed_key", "file_path", F.concat(F.lit("new_"), "feed_key").alias("request_id"))
    return inventory.manifest_rows(asked, listed, v.NOW)


_MANIFEST_COLS = ("feed_key, request_id, file_name, file_path, file_fingerprint, file_size, src_mtime_ms, vendor_code, file_date, "
                  "part_group_key, parse_status, ts_discovered, load_status, cnt_row_bronze, flg_latest, promote_status, status_reason")
_DISCOVERED = f"""v_disc AS (SELECT feed_key, 'new_' || feed_key AS request_id, file_name, file_path, file_fingerprint, size AS file_size,
  mtime AS src_mtime_ms, vendor_code, file_date, part_group_key, parse_status, TIMESTAMP '{v.NOW}' AS ts_discovered,
  CASE WHEN bad THEN 'PARSE_FAILED' ELSE 'DISCOVERED' END AS load_status, NULL::BIGINT AS cnt_row_bronze, 'N' AS flg_latest,
  'NOT_READY' AS promote_status, coalesce(parse_reason, 'discovered') AS status_reason FROM v_listing)"""


@query(v.sql("listing", f"SELECT {_MANIFEST_COLS} FROM v_disc", _DISCOVERED))
def manifest_rows(spark, sf_dir):
    return _discovered(spark, sf_dir).select(*_MANIFEST_COLS.split(", "))


@query(v.sql("listing known", """
SELECT coalesce(d.file_fingerprint, k.file_fingerprint) AS file_fingerprint, coalesce(d.request_id, k.request_id) AS request_id,
  coalesce(d.ts_discovered, k.ts_discovered) AS ts_discovered, coalesce(k.load_status, d.load_status) AS load_status,
  CASE WHEN k.file_fingerprint IS NOT NULL THEN k.cnt_row_bronze ELSE d.cnt_row_bronze END AS cnt_row_bronze,
  coalesce(d.status_reason, k.status_reason) AS status_reason, d.file_fingerprint IS NULL AND k.dispatch_run_id IS NOT NULL AS kept_run
FROM v_disc d FULL JOIN v_known k ON d.file_fingerprint = k.file_fingerprint""", _DISCOVERED))
def merge_inventory(spark, sf_dir):
    merged = inventory.merge_inventory(v.known_inventory(spark, sf_dir), _discovered(spark, sf_dir))
    return merged.select("file_fingerprint", "request_id", "ts_discovered", "load_status", "cnt_row_bronze", "status_reason",
                         F.col("dispatch_run_id").isNotNull().alias("kept_run"))


@query(v.sql("inventory", """
SELECT file_fingerprint, CASE WHEN hit THEN 'LOADED_BRONZE' ELSE load_status END AS load_status,
  CASE WHEN hit THEN file_size ELSE cnt_row_bronze END AS cnt_row_bronze, CASE WHEN hit THEN 'req_load' ELSE request_id END AS request_id,
  CASE WHEN hit THEN 'bronze load completed' ELSE status_reason END AS status_reason
FROM (SELECT *, load_status = 'DISCOVERED' AND file_extension = 'txt' AS hit FROM v_inventory)"""))
def mark_loaded(spark, sf_dir):
    inv = v.inventory(spark, sf_dir)
    loads = inv.filter("load_status = 'DISCOVERED' AND file_extension = 'txt'").select(
        "file_fingerprint", F.col("file_size").alias("cnt_row_bronze"), F.lit("req_load").alias("request_id"), F.lit("run_load").alias("dispatch_run_id"))
    return inventory.mark_loaded(inv, loads).select("file_fingerprint", "load_status", "cnt_row_bronze", "request_id", "status_reason")


# ---- configuration ---------------------------------------------------------------------------

_FILLED_COLS = ("feed_key, feed_sub_key, ctl_active, ctl_auto_trigger, ctl_sync_config, src_subdir, src_uri, ctl_demo_seed_policy, tgt_bronze_table, "
                "tgt_silver_table, tgt_gold_table, tgt_volume, batch_max_files, batch_max_size_gb, sched_cron, sched_timezone, notify_recipients, row_no")


def _filled(spark, sf_dir):
    return config_sync.fill_defaults(v.raw_config(spark, sf_dir))


@query(v.sql("config", f"SELECT {_FILLED_COLS} FROM v_filled"))
def config_defaults(spark, sf_dir):
    return _filled(spark, sf_dir).select(*_FILLED_COLS.split(", "))


@query(v.sql("config", f"SELECT {_FILLED_COLS}, config_source_file FROM v_config"))
def config_dedup(spark, sf_dir):
    return config_sync.deduplicate(_filled(spark, sf_dir)).select(*_FILLED_COLS.split(", "), "config_source_file")


@query(v.sql("config", """
SELECT feed_key, feed_sub_key, config_source_file AS dropped_from, row_no,
  CASE WHEN hn = 1 THEN next_file ELSE head_file END AS winner_from,
  CASE WHEN hn = 1 THEN 'superseded by newer file ' || next_file WHEN config_source_file = head_file THEN 'duplicate in same file; earlier row kept'
    ELSE 'duplicate in older file; earlier row kept' END AS reason
FROM (SELECT *, first_value(config_source_file) OVER g AS head_file, row_number() OVER g AS hn FROM v_filled
      WINDOW g AS (PARTITION BY feed_key, feed_sub_key, mtime ORDER BY config_source_file, row_no)) r
LEFT JOIN (SELECT feed_key AS fk, feed_sub_key AS fs, mtime AS mt, lead(f) OVER (PARTITION BY feed_key, feed_sub_key ORDER BY mtime) AS next_file
           FROM (SELECT feed_key, feed_sub_key, mtime, arg_min(config_source_file, (config_source_file, row_no)) AS f FROM v_filled GROUP BY 1, 2, 3)) h
  ON r.feed_key = fk AND r.feed_sub_key = fs AND r.mtime = mt
WHERE hn > 1 OR next_file IS NOT NULL"""))
def config_dropped(spark, sf_dir):
    return config_sync.dropped(_filled(spark, sf_dir))


@query(v.sql("config", """
SELECT feed_key, feed_sub_key, CASE WHEN ctl_demo_seed_policy IN ('copy', 'AUTO') THEN upper(ctl_demo_seed_policy) ELSE 'AUTO' END AS ctl_demo_seed_policy,
  upper(ctl_sync_config) AS ctl_sync_config, CASE WHEN schema_read_policy = 'seed' THEN 'SEED' ELSE 'FIRST_FILE' END AS schema_read_policy,
  CASE WHEN batch_max_files = 0 THEN 10 ELSE batch_max_files END AS batch_max_files, batch_max_size_gb, 1440 AS sched_lookback_minutes,
  notify_recipients, ctl_demo_seed_policy = 'copy' OR (row_no % 2 = 0) AS refresh_seed
FROM v_config"""))
def config_normalize(spark, sf_dir):
    cfg = config_sync.normalize(config_sync.deduplicate(_filled(spark, sf_dir)))
    return cfg.select("feed_key", "feed_sub_key", "ctl_demo_seed_policy", "ctl_sync_config", "schema_read_policy", "batch_max_files", "batch_max_size_gb",
                      "sched_lookback_minutes", "notify_recipients",
                      config_sync.refresh_seed(F.col("ctl_demo_seed_policy"), True, F.pmod("row_no", F.lit(2)) == 0).alias("refresh_seed"))


@query(v.sql("config", """
SELECT feed_key, feed_sub_key, 'env=prod requires src_uri for feed_key=' || feed_key || '; set src_uri in config CSV/table for this feed' AS violation
FROM v_config WHERE src_uri = ''"""))
def config_policy(spark, sf_dir):
    return config_sync.policy_violations(config_sync.deduplicate(_filled(spark, sf_dir)), "prod", True)


@query(v.sql("config", "SELECT feed_key, feed_sub_key, row_no FROM v_config WHERE ctl_active = 'Y'"))
def config_active(spark, sf_dir):
    return config_sync.active(config_sync.deduplicate(_filled(spark, sf_dir))).select("feed_key", "feed_sub_key", "row_no")


def _first_sync(spark, sf_dir):
    """The configuration table after only the two oldest files were there."""
    rows = _filled(spark, sf_dir)
    return config_sync.deduplicate(rows.filter(F.col("config_source_mtime") < F.timestamp_seconds(F.lit(900002000))))


_FIRST = """v_first AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY feed_key, feed_sub_key ORDER BY mtime DESC, config_source_file, row_no) AS rn
  FROM v_filled WHERE mtime < 900002000) WHERE rn = 1)"""


@query(v.sql("config", "SELECT c.feed_key, c.feed_sub_key, c.row_no FROM v_config c LEFT JOIN v_first f USING (feed_key, feed_sub_key) WHERE f.row_no IS NULL", _FIRST))
def config_new_keys(spark, sf_dir):
    new = config_sync.new_keys(config_sync.deduplicate(_filled(spark, sf_dir)), _first_sync(spark, sf_dir))
    return new.select("feed_key", "feed_sub_key", "row_no")


def _with_dir(alias):
    return f"CASE WHEN {alias}.src_uri <> '' THEN {alias}.src_uri ELSE '/Volumes/main/landing/' || {alias}.tgt_volume || '/' || {alias}.src_subdir END"


@query(v.sql("config", f"""
SELECT f.feed_key, f.feed_sub_key, CASE WHEN upper(c.ctl_sync_config) = 'Y' THEN c.sched_cron ELSE f.sched_cron END AS sched_cron,
  CASE WHEN upper(c.ctl_sync_config) = 'Y' THEN c.tgt_bronze_table ELSE f.tgt_bronze_table END AS tgt_bronze_table,
  CASE WHEN upper(c.ctl_sync_config) = 'Y' THEN c.config_source_file ELSE f.config_source_file END AS config_source_file,
  c.src_uri, c.ctl_demo_seed_policy, {_with_dir('c')} AS uc_source_dir
FROM v_first f JOIN v_config c USING (feed_key, feed_sub_key)""", _FIRST))
def merge_config(spark, sf_dir):
    root = "/Volumes/main/landing"
    old = config_sync.with_source_dir(_first_sync(spark, sf_dir), root)
    new = config_sync.with_source_dir(config_sync.deduplicate(_filled(spark, sf_dir)), root)
    return config_sync.merge_config(old, new).select(
        "feed_key", "feed_sub_key", "sched_cron", "tgt_bronze_table", "config_source_file", "src_uri", "ctl_demo_seed_policy", "uc_source_dir")


@query(v.sql("config", """
SELECT feed_key, feed_sub_key, CASE WHEN feed_key = 'feed_7' THEN '0 0 * * * ?' ELSE sched_cron END AS sched_cron,
  CASE WHEN feed_key = 'feed_7' THEN '{"request_type":"BACKFILL"}' ELSE '' END AS sys_default_request_json FROM v_config"""))
def backfill_override(spark, sf_dir):
    cfg = config_sync.deduplicate(_filled(spark, sf_dir))
    return config_sync.backfill_override(cfg, "feed_7", '{"request_type":"BACKFILL"}', "0 0 * * * ?").select(
        "feed_key", "feed_sub_key", "sched_cron", "sys_default_request_json")


# ---- generic keyed operations ----------------------------------------------------------------

@query("""
SELECT coalesce(c.c_custkey, o.o_custkey) AS custkey, CASE WHEN c.c_custkey IS NOT NULL AND o.n > 12 THEN 'BUSY' ELSE c.c_mktsegment END AS segment,
  CASE WHEN c.c_custkey IS NULL THEN o.total WHEN o.n > 12 THEN c.c_acctbal WHEN o.n IS NOT NULL THEN o.total ELSE c.c_acctbal END AS balance
FROM (SELECT * FROM customer WHERE c_acctbal >= 0) c
FULL JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS total FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey""")
def upsert(spark, sf_dir):
    """Two matched clauses and an insert: customers with a balance merged with what the orders say."""
    c = v.table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    o = v.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("balance"))
    return ups.upsert(c, o, ["custkey"], [(ups.src("n") > 12, {"segment": F.lit("BUSY")}), (F.lit(True), {"balance": ups.src("balance")})])


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_totalprice >= 1000""")
def update_delete(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders")
    kept = ups.delete_where(o, F.col("o_totalprice") < 1000)
    return ups.update_where(kept, F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("F")}).select("o_orderkey", "o_orderstatus")
