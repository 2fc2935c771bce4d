"""Data quality over order rows, one file per order year."""
from __future__ import annotations

from pyspark.sql import functions as F

from feedyard import schemas
from feedyard.checks import dropzone, loading, views as v
from feedyard.functions.fingerprints import enrich_listing
from feedyard.operators import commits, inventory, quality as q
from feedyard.operators.quality import Rule
from feedyard.plans import ingest
from feedyard.session import stable, work_dir
from feedyard.sources.listing import list_files

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


RULES = [
    Rule("id_present", 1, "order_id IS NOT NULL", "FAIL", None, (), "COMPLETENESS"),
    Rule("customer_present", 1, "customer IS NOT NULL", "FAIL", 5.0, (), "COMPLETENESS"),
    Rule("not_2001", 1, "NOT coalesce(order_date, '') LIKE '2001%'", "FAIL", None, (), "TIMELINESS"),
    Rule("date_present", 2, "order_date IS NOT NULL", "DROP", 2.0, (), "COMPLETENESS"),
    Rule("date_castable", 2, "CAST(order_date AS DATE) IS NOT NULL", "DROP", 10.0, ("date_present",)),
    Rule("status_valid", 2, "status IN ('O','F')", "QUARANTINE", 10.0),
    Rule("total_castable", 2, "CAST(total AS DOUBLE) IS NOT NULL", "WARN", 1.0),
    Rule("total_range", 2, "CAST(total AS DOUBLE) BETWEEN 0 AND 1000000", "WARN", 50.0, ("total_castable",), "ACCURACY"),
    Rule("date_recent", 3, "CAST(order_date AS DATE) <= current_date()", "WARN", 20.0, ("date_castable",), "TIMELINESS"),
    Rule("loop_a", 3, "status = 'O'", "WARN", None, ("loop_b",)),
    Rule("loop_b", 3, "status = 'O'", "WARN", None, ("loop_a",)),
    Rule("prio_known", 3, "priority RLIKE '^[1-3]'", "WARN", None),
    Rule("needs_ghost", 3, "status = 'O'", "WARN", None, ("ghost",)),
    Rule("customer_long", 3, "length(customer) >= 1", "WARN", 2.5),
]


def rows(spark, sf_dir):
    """Orders as delivered text, with gaps and damage."""
    o = v.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("orders_"), F.year("o_orderdate"), F.lit(".txt"))
    return o.select(
        k.cast("string").alias("order_id"), F.when(F.pmod("o_custkey", F.lit(50)) != 0, F.col("o_custkey").cast("string")).alias("customer"),
        F.col("o_orderstatus").alias("status"), F.when(F.pmod(k, F.lit(37)) == 0, "n/a").otherwise(F.col("o_totalprice").cast("int").cast("string")).alias("total"),
        F.when(F.pmod(k, F.lit(23)) == 0, "soon").when(F.pmod(k, F.lit(29)) != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.col("o_orderpriority").alias("priority"), F.lit("orders").alias("feed_key"), name.alias("file_name"), F.sha2(name, 256).alias("file_fingerprint"),
        (k + 2).alias("src_row_number"))


_ROWS = """v_rows AS (
  SELECT o_orderkey::VARCHAR AS order_id, CASE WHEN o_custkey % 50 <> 0 THEN o_custkey::VARCHAR END AS customer, o_orderstatus AS status,
    CASE WHEN o_orderkey % 37 = 0 THEN 'n/a' ELSE trunc(o_totalprice)::INT::VARCHAR END AS total,
    CASE WHEN o_orderkey % 23 = 0 THEN 'soon' WHEN o_orderkey % 29 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    o_orderpriority AS priority, 'orders_' || year(o_orderdate) || '.txt' AS file_name, sha256('orders_' || year(o_orderdate) || '.txt') AS file_fingerprint,
    o_orderkey + 2 AS src_row_number FROM orders),
v_tests AS (
  SELECT *, order_id IS NOT NULL AS r1, customer IS NOT NULL AS r2, coalesce(order_date, '') NOT LIKE '2001%' AS r3, order_date IS NOT NULL AS r4,
    try_cast(order_date AS DATE) IS NOT NULL AS r5, status IN ('O', 'F') AS r6, try_cast(total AS DOUBLE) IS NOT NULL AS r7,
    coalesce(try_cast(total AS DOUBLE) BETWEEN 0 AND 1000000, false) AS r8, coalesce(try_cast(order_date AS DATE) <= DATE '2001-06-01', false) AS r9,
    status = 'O' AS r10, status = 'O' AS r11, regexp_matches(priority, '^[1-3]') AS r12, status = 'O' AS r13, coalesce(length(customer) >= 1, false) AS r14
  FROM v_rows),
v_t1 AS (
  SELECT file_fingerprint, count(*) AS n, count(*) FILTER (NOT r1) AS f1, count(*) FILTER (NOT r2) AS f2, count(*) FILTER (NOT r3) AS f3,
    count(*) FILTER (NOT r1) > 0 OR 100.0 * count(*) FILTER (NOT r2) / count(*) > 5 OR count(*) FILTER (NOT r3) > 0 AS aborted
  FROM v_tests GROUP BY 1),
v_t2 AS (
  SELECT t.file_fingerprint, count(*) AS n, count(*) FILTER (NOT r4) AS f4, count(*) FILTER (NOT r5) AS f5, count(*) FILTER (NOT r6) AS f6,
    count(*) FILTER (NOT r7) AS f7, count(*) FILTER (NOT r8) AS f8, 100.0 * count(*) FILTER (NOT r4) / count(*) > 2 AS drop4,
    100.0 * count(*) FILTER (NOT r5) / count(*) > 10 AS drop5raw, 100.0 * count(*) FILTER (NOT r6) / count(*) > 10 AS quar6,
    100.0 * count(*) FILTER (NOT r7) / count(*) > 1 AS warn7
  FROM v_tests t JOIN v_t1 USING (file_fingerprint) WHERE NOT aborted GROUP BY 1),
v_alive AS (
  SELECT t.*, u.drop4, u.drop5raw AND NOT u.drop4 AS drop5, u.quar6 FROM v_tests t JOIN v_t2 u USING (file_fingerprint)),
v_t3 AS (
  SELECT file_fingerprint, count(*) AS n, count(*) FILTER (NOT r9) AS f9, count(*) FILTER (NOT r12) AS f12, count(*) FILTER (NOT r14) AS f14,
    any_value(drop4) AS drop4, any_value(drop5) AS drop5
  FROM v_alive WHERE NOT (drop4 AND NOT r4) AND NOT (drop5 AND NOT r5) AND NOT (quar6 AND NOT r6) GROUP BY 1),
v_disposed AS (
  SELECT t.*, CASE WHEN a.aborted THEN 'ABORTED' WHEN (u.drop4 AND NOT r4) OR (u.drop5raw AND NOT u.drop4 AND NOT r5) THEN 'DROPPED'
    WHEN u.quar6 AND NOT r6 THEN 'QUARANTINED' ELSE 'KEPT' END AS disposition
  FROM v_tests t JOIN v_t1 a USING (file_fingerprint) LEFT JOIN v_t2 u USING (file_fingerprint)),
v_long AS (
  SELECT file_fingerprint, 'id_present' AS rule_name, n AS t, f1 AS f, CASE WHEN f1 > 0 THEN 'FAILED' ELSE 'PASSED' END AS outcome FROM v_t1 UNION ALL
  SELECT file_fingerprint, 'customer_present', n, f2, CASE WHEN 100.0 * f2 / n > 5 THEN 'FAILED' ELSE 'PASSED' END FROM v_t1 UNION ALL
  SELECT file_fingerprint, 'not_2001', n, f3, CASE WHEN f3 > 0 THEN 'FAILED' ELSE 'PASSED' END FROM v_t1 UNION ALL
  SELECT file_fingerprint, 'date_present', n, f4, CASE WHEN drop4 THEN 'DROPPED' ELSE 'PASSED' END FROM v_t2 UNION ALL
  SELECT file_fingerprint, 'date_castable', CASE WHEN drop4 THEN 0 ELSE n END, CASE WHEN drop4 THEN 0 ELSE f5 END,
    CASE WHEN drop4 THEN 'SKIPPED' WHEN drop5raw THEN 'DROPPED' ELSE 'PASSED' END FROM v_t2 UNION ALL
  SELECT file_fingerprint, 'status_valid', n, f6, CASE WHEN quar6 THEN 'QUARANTINED' ELSE 'PASSED' END FROM v_t2 UNION ALL
  SELECT file_fingerprint, 'total_castable', n, f7, CASE WHEN warn7 THEN 'WARNED' ELSE 'PASSED' END FROM v_t2 UNION ALL
  SELECT file_fingerprint, 'total_range', n, f8, CASE WHEN 100.0 * f8 / n > 50 THEN 'WARNED' ELSE 'PASSED' END FROM v_t2 UNION ALL
  SELECT file_fingerprint, 'date_recent', CASE WHEN drop4 OR drop5 THEN 0 ELSE n END, CASE WHEN drop4 OR drop5 THEN 0 ELSE f9 END,
    CASE WHEN drop4 OR drop5 THEN 'SKIPPED' WHEN 100.0 * f9 / n > 20 THEN 'WARNED' ELSE 'PASSED' END FROM v_t3 UNION ALL
  SELECT file_fingerprint, unnest(['loop_a', 'loop_b', 'needs_ghost']), 0, 0, 'SKIPPED' FROM v_t3 UNION ALL
  SELECT file_fingerprint, 'prio_known', n, f12, CASE WHEN f12 > 0 THEN 'WARNED' ELSE 'PASSED' END FROM v_t3 UNION ALL
  SELECT file_fingerprint, 'customer_long', n, f14, CASE WHEN 100.0 * f14 / n > 2.5 THEN 'WARNED' ELSE 'PASSED' END FROM v_t3)"""
_QUAR_RULES = """v_viol AS (
  SELECT file_fingerprint, src_row_number, x.rule_name, x.vals AS column_values, x.cols AS columns_violated FROM v_disposed, LATERAL (VALUES
    ('customer_present', r2, 'customer', coalesce(customer, '')), ('status_valid', r6, 'status', status),
    ('total_castable', r7, 'total', total), ('total_range', r8, 'total', total)) x(rule_name, ok, cols, vals)
  WHERE disposition = 'QUARANTINED' AND NOT x.ok
    AND NOT (x.rule_name = 'total_range' AND file_fingerprint IN (SELECT file_fingerprint FROM v_long WHERE rule_name = 'total_range' AND outcome = 'SKIPPED')))"""
_TODAY = "2001-06-01"


def _masked(spark, sf_dir):
    return q.with_mask(rows(spark, sf_dir), RULES, _TODAY)


def _state(spark, sf_dir):
    return q.decide(_masked(spark, sf_dir), RULES)


def _disposed(spark, sf_dir):
    masked = _masked(spark, sf_dir)
    return q.dispose(masked, q.decide(masked, RULES), RULES)


_LETTERS = " || ".join(f"(CASE WHEN r{i} THEN '0' ELSE '1' END)" for i in range(1, 15))


@query(v.sql("", f"SELECT order_id, {_LETTERS} AS mask FROM v_tests", _ROWS))
def dq_flags(spark, sf_dir):
    return _masked(spark, sf_dir).select("order_id", F.col("_mask").alias("mask"))


@query(v.sql("", """SELECT file_name, rule_name, cnt_total, cnt_pass, cnt_total - cnt_pass AS cnt_fail, 100.0 * (cnt_total - cnt_pass) / cnt_total AS pct_fail
FROM (SELECT file_name, count(*) AS cnt_total, """ + ", ".join(f"count(*) FILTER (r{i}) AS p{i}" for i in range(1, 15)) + """ FROM v_tests GROUP BY 1),
LATERAL (VALUES """ + ", ".join(f"('{r.name}', p{i})" for i, r in enumerate(RULES, 1)) + ") x(rule_name, cnt_pass)", _ROWS))
def dq_metrics(spark, sf_dir):
    return q.rule_metrics(rows(spark, sf_dir), RULES, _TODAY, ["file_name"])


@query(v.sql("", """SELECT file_fingerprint, rule_name, t::BIGINT AS cnt_total, (t - f)::BIGINT AS cnt_pass, f::BIGINT AS cnt_fail, outcome,
  CASE WHEN outcome IN ('PASSED', 'SKIPPED') THEN 'N' ELSE 'Y' END AS threshold_breached FROM v_long""", _ROWS))
def dq_outcomes(spark, sf_dir):
    return q.results(_state(spark, sf_dir), RULES).select(
        "file_fingerprint", "rule_name", F.col("cnt_total").cast("bigint").alias("cnt_total"), F.col("cnt_pass").cast("bigint").alias("cnt_pass"),
        F.col("cnt_fail").cast("bigint").alias("cnt_fail"), "outcome", "threshold_breached")


@query(v.sql("", """SELECT file_fingerprint, rule_name, CASE WHEN rule_name LIKE 'loop%' THEN 'circular dependency' WHEN rule_name = 'needs_ghost' THEN 'dependency ghost not evaluated'
  WHEN rule_name = 'date_recent' THEN 'dependency date_castable not met' WHEN rule_name = 'date_castable' THEN 'dependency date_present not met' END AS skip_reason
FROM v_long WHERE outcome = 'SKIPPED'""", _ROWS))
def dq_dependencies(spark, sf_dir):
    return q.results(_state(spark, sf_dir), RULES).filter("outcome = 'SKIPPED'").select("file_fingerprint", "rule_name", "skip_reason")


@query(v.sql("", "SELECT order_id, disposition FROM v_disposed", _ROWS))
def dq_waterfall(spark, sf_dir):
    return _disposed(spark, sf_dir).select("order_id", "disposition")


@query(v.sql("", "SELECT order_id, customer, status, total, order_date FROM v_disposed WHERE disposition = 'KEPT'", _ROWS))
def dq_drop(spark, sf_dir):
    return q.kept(_disposed(spark, sf_dir), RULES).select("order_id", "customer", "status", "total", "order_date")


@query(v.sql("", """SELECT sha256(file_fingerprint || '|' || src_row_number) AS quarantine_id, order_id, customer, status, total, order_date, priority, src_row_number
FROM v_disposed WHERE disposition = 'QUARANTINED'""", _ROWS))
def dq_quarantine(spark, sf_dir):
    return q.quarantined(_disposed(spark, sf_dir), RULES).select(
        "quarantine_id", "order_id", "customer", "status", "total", "order_date", "priority", "src_row_number")


@query(v.sql("", "SELECT file_fingerprint, src_row_number, rule_name, columns_violated, column_values FROM v_viol", _ROWS + ",\n" + _QUAR_RULES))
def dq_violations(spark, sf_dir):
    return q.violations(_disposed(spark, sf_dir), RULES).select("file_fingerprint", "src_row_number", "rule_name", "columns_violated", "column_values")


@query(v.sql("", "SELECT rule_name, columns_violated, order_id, customer, total FROM v_viol JOIN v_disposed USING (file_fingerprint, src_row_number)", _ROWS + ",\n" + _QUAR_RULES))
def dq_violations_joined(spark, sf_dir):
    d = _disposed(spark, sf_dir)
    return q.violations(d, RULES).select("quarantine_id", "rule_name", "columns_violated").join(q.quarantined(d, RULES), "quarantine_id").select(
        "rule_name", "columns_violated", "order_id", "customer", "total")


@query(v.sql("", "SELECT rule_name, 'orders' AS feed_key, count(*) AS cnt FROM v_viol GROUP BY 1", _ROWS + ",\n" + _QUAR_RULES))
def dq_top_rules(spark, sf_dir):
    return q.top_rules(q.violations(_disposed(spark, sf_dir), RULES).withColumn("feed_key", F.lit("orders")))


@query(v.sql("", """SELECT file_fingerprint, CASE WHEN bool_or(outcome = 'FAILED') THEN 'FAILED' WHEN bool_or(outcome = 'QUARANTINED') THEN 'QUARANTINED'
  WHEN bool_or(outcome IN ('WARNED', 'DROPPED')) THEN 'WARNED' ELSE 'PASSED' END AS dq_status FROM v_long GROUP BY 1""", _ROWS))
def dq_file_status(spark, sf_dir):
    return q.file_status(_state(spark, sf_dir), RULES)


@query(v.sql("", """SELECT file_fingerprint, rule_name, CASE outcome WHEN 'FAILED' THEN 'ERROR' ELSE 'WARNING' END AS severity,
  CASE outcome WHEN 'FAILED' THEN 'DQ_FILE_FAILED' WHEN 'WARNED' THEN 'DQ_THRESHOLD_BREACHED' WHEN 'DROPPED' THEN 'DQ_ROWS_DROPPED' ELSE 'DQ_ROWS_QUARANTINED' END AS event_type,
  'Rule ' || rule_name || ' ' || lower(outcome) || ': ' || f || ' of ' || t || ' rows failed' AS message
FROM v_long WHERE outcome NOT IN ('PASSED', 'SKIPPED')""", _ROWS))
def dq_notifications(spark, sf_dir):
    return q.dq_notifications(q.results(_state(spark, sf_dir), RULES)).select("file_fingerprint", "rule_name", "severity", "event_type", "message")


@query(v.sql("", """SELECT order_id, CASE WHEN failed = '' THEN 'PASSED' ELSE 'FAILED' END AS dq_status, failed AS dq_rules_failed FROM (
  SELECT order_id, concat_ws(',', """ + ", ".join(f"CASE WHEN NOT r{i} THEN '{r.name}' END" for i, r in enumerate(RULES, 1)) + ") AS failed FROM v_tests)", _ROWS))
def dq_row_flags(spark, sf_dir):
    return q.row_flags(rows(spark, sf_dir), RULES, _TODAY).select("order_id", "dq_status", F.array_join("dq_rules_failed", ",").alias("dq_rules_failed"))


@query("""SELECT 'part_' || p_brand AS feed_key, 'rule_' || p_partkey AS rule_name, (1 + p_size % 3)::INT AS rule_tier, CASE WHEN p_partkey % 4 = 0 THEN 'rule_' || (p_partkey - 1) END AS depends_on,
  CASE WHEN p_partkey % 5 > 0 THEN (p_size / 2.0)::DOUBLE END AS threshold_pct, CASE p_partkey % 4 WHEN 0 THEN 'WARN' WHEN 1 THEN 'DROP' WHEN 2 THEN 'FAIL' ELSE 'QUARANTINE' END AS action_on_failure,
  CASE WHEN p_partkey % 6 = 0 THEN 'N' ELSE 'Y' END AS is_active FROM part""")
def dq_rules_sync(spark, sf_dir):
    p = v.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    raw = p.select(
        F.concat(F.lit(" part_"), "p_brand").alias("feed_key"), F.concat(F.lit("rule_"), k).alias("rule_name"), (1 + F.pmod("p_size", F.lit(3))).cast("string").alias("rule_tier"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.concat(F.lit("rule_"), k - 1)).otherwise(" ").alias("depends_on"), F.lit("validity").alias("rule_type"),
        F.lit("x IS NOT NULL").alias("rule_expression"),
        F.element_at(F.array(F.lit("warn"), F.lit("Drop"), F.lit("FAIL"), F.lit(" quarantine")), F.pmod(k, F.lit(4)).cast("int") + 1).alias("action_on_failure"),
        F.when(F.pmod(k, F.lit(5)) > 0, (F.col("p_size") / 2).cast("string")).otherwise("").alias("threshold_pct"),
        F.when(F.pmod(k, F.lit(6)) == 0, "n").otherwise("").alias("is_active"))
    return q.read_rules(raw, "dq_rules.csv", v.NOW).select("feed_key", "rule_name", "rule_tier", "depends_on", "threshold_pct", "action_on_failure", "is_active")


@query(v.sql("adjudicated", """SELECT file_fingerprint, CASE WHEN flg_legit_for_silver = 'Y' AND dq IN ('FAILED', 'QUARANTINED') THEN 'NOT_READY' ELSE promote_status END AS promote_status,
  CASE WHEN flg_legit_for_silver = 'Y' AND dq IN ('FAILED', 'QUARANTINED') THEN 'latest but data quality not passed' ELSE status_reason END AS status_reason
FROM (SELECT *, CASE file_size % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'QUARANTINED' WHEN 2 THEN 'WARNED' WHEN 3 THEN 'PASSED' END AS dq FROM v_adjudicated)"""))
def adjudicate_dq(spark, sf_dir):
    status = F.element_at(F.array(F.lit("FAILED"), F.lit("QUARANTINED"), F.lit("WARNED"), F.lit("PASSED"), F.lit(None).cast("string")), F.pmod("file_size", F.lit(5)).cast("int") + 1)
    return inventory.adjudicate(v.inventory(spark, sf_dir).withColumn("dq_status", status)).select("file_fingerprint", "promote_status", "status_reason")


# Rules as a file of them says it: a file that fails, rows that go, rows set aside, warnings, a skipped rule, two that wait for each other, one switched off.
_RULE_LINES = (
    ("key_number", 1, "", "CAST(custkey AS INT) IS NOT NULL", "FAIL", ""), ("good_block", 1, "", "CAST(custkey AS INT) % 400 <> 13", "FAIL", ""),
    ("low_nation", 2, "", "coalesce(CAST(nation AS INT), 0) < 20", "drop", "15"), ("no_three", 2, "", "CAST(custkey AS INT) % 10 <> 3", "quarantine", "5"),
    ("named", 3, "key_number", "name IS NOT NULL AND length(segment) < 10", "WARN", "40"), ("after_drop", 3, "low_nation", "name IS NOT NULL", "WARN", ""),
    ("ping", 3, "pong", "true", "WARN", ""), ("pong", 3, "ping", "true", "WARN", ""))
_STAGE = """v_all AS (SELECT *, chunk % 3 <> 2 AS ruled, c_custkey % 400 <> 13 AS a, coalesce(try_cast(nation AS INT), 0) < 20 AS b, c_custkey % 10 <> 3 AS c FROM v_cust),
v_f1 AS (SELECT chunk, ruled, count(*) AS n, count(*) FILTER (NOT a) > 0 AS failed, 100.0 * count(*) FILTER (NOT b) / count(*) > 15 AS drops,
  100.0 * count(*) FILTER (NOT c) / count(*) > 5 AS holds FROM v_all GROUP BY ALL),
v_rows2 AS (SELECT x.*, f.failed, f.drops, f.holds, CASE WHEN NOT x.ruled THEN 'KEPT' WHEN failed THEN 'ABORTED' WHEN drops AND NOT b THEN 'DROPPED' WHEN holds AND NOT c THEN 'QUARANTINED'
  ELSE 'KEPT' END AS word FROM v_all x JOIN v_f1 f USING (chunk)),
v_f2 AS (SELECT chunk, any_value(ruled) AS ruled, any_value(failed) AS failed, any_value(drops) AS drops, any_value(holds) AS holds, count(*) FILTER (word = 'KEPT') AS kept,
  count(*) FILTER (word = 'QUARANTINED') AS held, count(*) FILTER (word = 'QUARANTINED' AND NOT b) AS also_b, count(*) FILTER (word = 'KEPT' AND coalesce(length(segment) < 10, false) = false) AS odd FROM v_rows2 GROUP BY chunk),
v_f3 AS (SELECT *, kept > 0 AND 100.0 * odd / kept > 40 AS warns FROM v_f2)"""


@query(v.sql("", """SELECT 'customers_' || chunk || '.txt' AS file_name, CASE WHEN NOT ruled THEN 'NOT_EVALUATED' WHEN failed THEN 'FAILED' WHEN holds THEN 'QUARANTINED' WHEN drops OR warns THEN 'WARNED' ELSE 'PASSED' END AS dq_status,
  CASE WHEN ruled AND failed THEN 'DISCOVERED' ELSE 'LOADED_BRONZE' END AS load_status, CASE WHEN NOT (ruled AND failed) THEN kept END AS cnt, CASE WHEN ruled THEN held ELSE 0 END AS quarantined,
  CASE WHEN ruled THEN held + also_b ELSE 0 END AS violations, CASE WHEN NOT ruled THEN 0 WHEN failed THEN 2 ELSE 8 END AS results,
  CASE WHEN NOT ruled THEN 0 WHEN failed THEN 1 ELSE drops::INT + holds::INT + warns::INT END AS notices,
  CASE WHEN ruled AND failed THEN 'FAILED' ELSE 'SUCCEEDED' END AS ended,
  CASE WHEN NOT ruled OR (NOT failed AND NOT holds AND kept > 0) THEN 'READY_FOR_SILVER' ELSE 'NOT_READY' END AS promote_status,
  CASE WHEN ruled THEN 1 ELSE 0 END AS cycles FROM v_f3""", loading._CUST + ",\n" + _STAGE))
def dq_stage(spark, sf_dir):
    """From a file of rules over two loads, of a feed with rules and of one without, to the adjudicated inventory."""
    raw = spark.createDataFrame([("ruled", n, str(t), d, "validity", x, a, p, "") for n, t, d, x, a, p in _RULE_LINES] + [("ruled", "off", "1", "", "validity", "false", "FAIL", "", "N")],
                                "feed_key string, rule_name string, rule_tier string, depends_on string, rule_type string, rule_expression string, action_on_failure string, threshold_pct string, is_active string")
    rules = q.read_rules(raw, "dq_rules.csv", v.NOW)
    refs = stable(enrich_listing(list_files(spark, dropzone.dropped(spark, sf_dir))))
    third = F.pmod(F.regexp_extract("file_name", r"_(\d+)\.", 1).cast("int"), F.lit(3)) == 2
    log, out = work_dir(spark, "logs"), None
    for feed, part in (("ruled", refs.filter(~third)), ("free", refs.filter(third))):
        table = work_dir(spark, f"bronze-{feed}")
        ingest.load(spark, ingest.Feed(feed, dropzone.FEED_REGEX, dropzone.FEED_SPEC), part, table, log, "batch_001", f"req_{feed}", "run_1", v.NOW,
                    policy="SEED", seed=["custkey", "name", "nation", "segment"], rules=rules)
        done = commits.manifests(spark, table)

        def counted(path, name, rows=None):
            rows = commits.committed(spark.read.parquet(path), done) if rows is None else rows
            return rows.groupBy("file_fingerprint").agg(F.count(F.lit(1)).alias(name))

        state = inventory.adjudicate(inventory.with_loads(spark.createDataFrame([], schemas.INVENTORY), commits.loaded_files(spark, table)))
        events = commits.committed(spark.read.parquet(f"{log}/file_log"), done).filter(F.col("feed_key") == feed)
        ended = events.filter("stage_name = 'INGEST_CONTROL' AND stage_status <> 'STARTED'").select("file_fingerprint", F.col("stage_status").alias("ended"))
        told = commits.committed(spark.read.parquet(f"{log}/notifications"), done)
        named = told.filter("event_type LIKE 'DQ%' AND category = 'INGESTION'").select(F.get_json_object("details_json", "$.file_name").alias("file_name")).groupBy("file_name").agg(
            F.count(F.lit(1)).alias("notices"))
        parts = [counted(f"{table}_quarantine", "quarantined"), counted(f"{log}/dq_violations", "violations"), counted(f"{log}/dq_results", "results")] if feed == "ruled" else []
        cycles = told.filter(F.col("event_type") == "DQ_DEPENDENCY_CYCLE").count()
        for p in (ended, *parts):
            state = state.join(p, "file_fingerprint", "left")
        state = state.join(named, "file_name", "left")
        zero = [F.coalesce(F.col(c) if c in state.columns else F.lit(None), F.lit(0)).cast("bigint").alias(c) for c in ("quarantined", "violations", "results", "notices")]
        rows = state.select("file_name", "dq_status", "load_status", F.col("cnt_row_bronze").alias("cnt"), "ended", "promote_status", F.lit(cycles).alias("cycles"), *zero)
        out = rows if out is None else out.unionByName(rows)
    return out
