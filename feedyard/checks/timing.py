"""Schedules and dispatch."""
from __future__ import annotations

from pyspark.sql import functions as F

from feedyard.checks import views as v
from feedyard.functions.text import parse_utc as to_utc
from feedyard.operators import config_sync, dispatch, schedule

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


# Schedules with their days and times said in SQL, for the oracle.
_DAYS = {
    "0 */15 9-17 ? * MON-FRI": "isodow BETWEEN 1 AND 5",
    "0 0 8 L * ?": "dom = ld",
    "0 30 5,17 * * ?": "true",
    "0 0 8 ? * 3#2": "isodow = 2 AND dom BETWEEN 8 AND 14",
    "0 0 0 1 1,4,7,10 ?": "dom = 1 AND mon IN (1, 4, 7, 10)",
    "0 0 8 15W * ?": "dom = CASE d15 WHEN 6 THEN 14 WHEN 7 THEN 16 ELSE 15 END",
    "0 0 20 ? * 2/2": "isodow = 1 AND wk % 2 = 0",
    "0 30 7 * * ?": "true",
    "0 0 11 * * ?": "true",
    "0 45 16 * * ?": "true",
    "10,40 0 2/6 LW * ?": "dom = ld - CASE dlast WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END",
    "0 5 23 L-3 FEB,MAR 6L": "mon IN (2, 3) AND (dom = ld - 3 OR (isodow = 5 AND dom > ld - 7))",
    "0 0 12 1-7,20 * 7": "dom BETWEEN 1 AND 7 OR dom = 20 OR isodow = 6",
}
_TIMES = {
    "0 */15 9-17 ? * MON-FRI": [h * 3600 + m * 60 for h in range(9, 18) for m in (0, 15, 30, 45)],
    "0 0 8 L * ?": [28800], "0 30 5,17 * * ?": [19800, 63000], "0 0 8 ? * 3#2": [28800], "0 0 0 1 1,4,7,10 ?": [0],
    "0 0 8 15W * ?": [28800], "0 0 20 ? * 2/2": [72000], "0 30 7 * * ?": [27000], "0 0 11 * * ?": [39600], "0 45 16 * * ?": [60300],
    "10,40 0 2/6 LW * ?": [h * 3600 + s for h in (2, 8, 14, 20) for s in (10, 40)],
    "0 5 23 L-3 FEB,MAR 6L": [82800 + 300], "0 0 12 1-7,20 * 7": [43200],
}
_EXPRS = list(_DAYS)
_BAD = ("*/5 * * * *", "0 0 99x * * ?", "0 0 8 ? * L", "0 0 0 1 1 ? 2026")
_ALL = _EXPRS + list(_BAD)

_SPINE = """v_spine AS (
  SELECT d::DATE AS d, isodow(d) AS isodow, day(d) AS dom, month(d) AS mon, day(last_day(d)) AS ld, week(d) AS wk,
    isodow(date_trunc('month', d) + INTERVAL 14 DAY) AS d15, isodow(last_day(d)) AS dlast
  FROM (SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE - 2 FROM orders)::TIMESTAMP,
                                      (SELECT max(o_orderdate)::DATE + 1500 FROM orders)::TIMESTAMP, INTERVAL 1 DAY)) AS d)),
v_days AS (""" + " UNION ALL ".join(f"SELECT '{e}' AS expr, d FROM v_spine WHERE {p}" for e, p in _DAYS.items()) + """),
v_times AS (""" + " UNION ALL ".join(f"SELECT '{e}' AS expr, unnest({t})::BIGINT AS tod" for e, t in _TIMES.items()) + """),
v_ask AS (
  SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS after, CASE o_orderkey % """ + str(len(_ALL)) + " ".join(
      f" WHEN {i} THEN '{e}'" for i, e in enumerate(_ALL)) + """ END AS expr,
    CASE o_custkey % 3 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'Asia/Kolkata' ELSE 'UTC' END AS tz,
    CASE o_custkey % 3 WHEN 0 THEN 540 WHEN 1 THEN 330 ELSE 0 END AS off FROM orders)"""


def _fire(asks: str, local: str) -> str:
    """Next fire of each row of ``asks(k, expr, local)``: on the same day, else first time of the next one."""
    return f"""
  SELECT k, min(f) AS f FROM (
    SELECT a.k, a.d + to_seconds(t.tod) AS f FROM {asks} a JOIN v_days d ON d.expr = a.expr AND d.d = a.{local}::DATE
      JOIN v_times t ON t.expr = a.expr WHERE a.d + to_seconds(t.tod) > a.{local}
    UNION ALL
    SELECT a.k, n.d + to_seconds(t.tod) FROM {asks} a ASOF JOIN v_days n ON n.expr = a.expr AND a.{local}::DATE < n.d
      JOIN (SELECT expr, min(tod) AS tod FROM v_times GROUP BY 1) t ON t.expr = a.expr) GROUP BY 1"""


def _asks(spark, sf_dir):
    """Every order asks for the next fire of one schedule after its own time."""
    o = v.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    pick = F.element_at(F.array(*[F.lit(e) for e in _ALL]), F.pmod(k, F.lit(len(_ALL))).cast("int") + 1)
    zone = F.element_at(F.array(F.lit("Asia/Tokyo"), F.lit("Asia/Kolkata"), F.lit("UTC")), F.pmod("o_custkey", F.lit(3)).cast("int") + 1)
    return o.select("o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(secs=F.pmod(k, F.lit(86400)).cast("int"))).alias("after"),
                    pick.alias("expr"), zone.alias("tz"))


@query(v.sql("", """SELECT a.o_orderkey, a.expr, f.f AS next_fire FROM v_ask a LEFT JOIN (""" + _fire("v_asks", "local") + """) f ON a.o_orderkey = f.k""",
             _SPINE + ", v_asks AS (SELECT o_orderkey AS k, expr, after AS local, after::DATE AS d FROM v_ask)"))
def next_fire(spark, sf_dir):
    return schedule.next_fire(_asks(spark, sf_dir), "expr", None, "after").select("o_orderkey", "expr", "next_fire")


@query(v.sql("", """SELECT a.o_orderkey, a.tz, f.f - to_minutes(a.off) AS next_fire FROM v_ask a LEFT JOIN (""" + _fire("v_asks", "local") + """) f ON a.o_orderkey = f.k""",
             _SPINE + ", v_asks AS (SELECT o_orderkey AS k, expr, after + to_minutes(off) AS local, (after + to_minutes(off))::DATE AS d FROM v_ask)"))
def next_fire_tz(spark, sf_dir):
    return schedule.next_fire(_asks(spark, sf_dir), "expr", "tz", "after").select("o_orderkey", "tz", "next_fire")


@query(v.sql("", """SELECT k AS o_orderkey, min(f) AS next_fire FROM (""" + _fire("v_asks", "local") + """) GROUP BY 1""",
             _SPINE + """, v_asks AS (SELECT o_orderkey AS k, x.expr, after AS local, after::DATE AS d FROM v_ask,
  (VALUES ('0 30 7 * * ?'), ('0 0 11 * * ?'), ('0 45 16 * * ?')) x(expr))"""))
def next_fire_multi(spark, sf_dir):
    """One piped schedule for all rows, with a malformed alternative that must be ignored."""
    rows = _asks(spark, sf_dir).withColumn("expr", F.lit("0 30 7 * * ? | bad expr | 0 0 11 * * ? |  | 0 45 16 * * ?"))
    return schedule.next_fire(rows, "expr", None, "after").select("o_orderkey", "next_fire")


@query(v.sql("", """
SELECT c_custkey, string_agg(x, ',' ORDER BY x) AS field_values FROM (
  SELECT c_custkey, unnest(CASE c_custkey % 6 WHEN 0 THEN range(0, 60) WHEN 1 THEN [c_nationkey] WHEN 2 THEN range(c_nationkey, c_nationkey + 4)
     WHEN 3 THEN range(0, 60, 1 + c_nationkey) WHEN 4 THEN range(c_nationkey, 60, 7)
     ELSE list_sort(list_distinct(list_concat([2], list_concat(range(10, 21, 3), range(50, 60, 5))))) END)::INT AS x FROM customer) GROUP BY 1"""))
def cron_field(spark, sf_dir):
    n = F.col("c_nationkey").cast("string")
    text = F.element_at(F.array(
        F.lit("*"), n, F.concat(n, F.lit("-"), (F.col("c_nationkey") + 3).cast("string")), F.concat(F.lit("*/"), (F.col("c_nationkey") + 1).cast("string")),
        F.concat(n, F.lit("/7")), F.lit("10-20/3,2, 50/5")), F.pmod("c_custkey", F.lit(6)).cast("int") + 1)
    values = v.table(spark, sf_dir, "customer").select("c_custkey", F.explode(schedule.field_values(text, 0, 59)).alias("x"))
    return values.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias("field_values"))


def _fire_days(spark, sf_dir, wanted):
    """For the day of every order, how often it fell on a firing day of each schedule."""
    days = v.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    asked = days.select("*", F.explode(F.array(*[F.lit(e) for e in wanted])).alias("expr"))
    spans = asked.groupBy("expr").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    hit = asked.join(schedule.firing_days(spans).filter("fires").select("expr", "day"), ["expr", "day"])
    return hit.groupBy("expr").agg(F.count(F.lit(1)).alias("fire_days"), F.sum("n").alias("orders"))


def _fire_days_sql(wanted):
    listed = ", ".join(f"'{e}'" for e in wanted)
    return v.sql("", f"""SELECT expr, count(*) AS fire_days, sum(n)::BIGINT AS orders FROM v_days JOIN (
  SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1) USING (d) WHERE expr IN ({listed}) GROUP BY 1""", _SPINE)


_DOM = [e for e in _EXPRS if e.split()[5] == "?" and e.split()[3] != "*"]
_DOW = [e for e in _EXPRS if e.split()[3] == "?"]
_BOTH = [e for e in _EXPRS if e.split()[3] not in "*?" and e.split()[5] not in "*?"]


@query(_fire_days_sql(_DOM))
def cron_dom(spark, sf_dir):
    return _fire_days(spark, sf_dir, _DOM)


@query(_fire_days_sql(_DOW))
def cron_dow(spark, sf_dir):
    return _fire_days(spark, sf_dir, _DOW)


@query(_fire_days_sql(_BOTH + ["0 30 5,17 * * ?"]))
def cron_days(spark, sf_dir):
    """Both day fields restricted fires on either; none restricted fires daily."""
    return _fire_days(spark, sf_dir, _BOTH + ["0 30 5,17 * * ?"])


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN date_trunc('second', ts) - INTERVAL 90 MINUTE
  WHEN 'error' THEN date_trunc('day', ts) END AS parsed FROM events""")
def parse_utc(spark, sf_dir):
    ev = v.table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+01:30'"))
            .when(F.col("event_type") == "error", F.date_format("ts", "' 'yyyy-MM-dd' '"))
            .when(F.col("event_type") == "signup", "tomorrow").otherwise(" "))
    return ev.select("event_id", to_utc(text).alias("parsed"))


# ---- dispatch --------------------------------------------------------------------------------

def _config(spark, sf_dir):
    return config_sync.normalize(config_sync.deduplicate(config_sync.fill_defaults(v.raw_config(spark, sf_dir)))).withColumn(
        "sched_timezone", F.lit("UTC"))


def _state(spark, sf_dir):
    """Feeds dispatched before: those with a non-blank sub key, at a time read off their row."""
    return _config(spark, sf_dir).filter("feed_sub_key <> 'DEFAULT'").select(
        "feed_key", "feed_sub_key", (F.lit(v.NOW).cast("timestamp") - F.make_dt_interval(hours=(F.col("row_no") * 5).cast("int"))).alias("last_dispatched_at"),
        (F.lit(v.NOW).cast("timestamp") - F.make_dt_interval(mins=((F.col("row_no") - 50) * 60).cast("int"))).alias("next_dispatched_at"),
        F.lit("run_old").alias("dispatch_run_id"))


def _active(spark, sf_dir):
    """Feeds with a run under way: those of rich suppliers."""
    return v.table(spark, sf_dir, "supplier").filter("s_acctbal > 8000").select(F.concat(F.lit("feed_"), F.pmod("s_suppkey", F.lit(40))).alias("feed_key"))


_STATE = f"""v_state AS (
  SELECT feed_key, feed_sub_key, TIMESTAMP '{v.NOW}' - to_hours(row_no * 5) AS last_dispatched_at,
    TIMESTAMP '{v.NOW}' - to_minutes((row_no - 50) * 60) AS next_dispatched_at, 'run_old' AS dispatch_run_id
  FROM v_config WHERE feed_sub_key <> 'DEFAULT')"""
_NOW_SPINE = _SPINE.split("v_ask AS")[0].rstrip().rstrip(",")
_GATES = _STATE + ",\n" + _NOW_SPINE + """,
v_gasks AS (
  SELECT feed_key || '/' || feed_sub_key AS k, trim(x.expr) AS expr, last_dispatched_at AS local, last_dispatched_at::DATE AS d
  FROM (SELECT feed_key, feed_sub_key, last_dispatched_at, unnest(string_split(sched_cron, '|')) AS expr FROM v_config JOIN v_state USING (feed_key, feed_sub_key)) x),
v_gates AS (
  SELECT c.feed_key, c.feed_sub_key, c.sched_cron, upper(ctl_active) = 'Y' AS gate_active, upper(ctl_auto_trigger) = 'Y' AS gate_auto,
    ctl_maintenance_hold_until <> '1998-12-24T00:00:00Z' AS gate_hold,
    CASE WHEN sched_cron = '' THEN false WHEN s.last_dispatched_at IS NULL THEN true
      ELSE coalesce(f.f <= TIMESTAMP '""" + v.NOW + """', false) END AS gate_due
  FROM v_config c LEFT JOIN v_state s USING (feed_key, feed_sub_key)
  LEFT JOIN (""" + _fire("v_gasks", "local") + """) f ON f.k = c.feed_key || '/' || c.feed_sub_key),
v_plan AS (
  SELECT *, gate_active AND gate_auto AND gate_hold AND gate_due AS eligible,
    feed_key IN (SELECT 'feed_' || (s_suppkey % 40) FROM supplier WHERE s_acctbal > 8000) AS busy FROM v_gates)"""


@query(v.sql("config", "SELECT feed_key, feed_sub_key, gate_active, gate_auto, gate_hold, gate_due, eligible FROM v_plan", _GATES))
def dispatch_gates(spark, sf_dir):
    return dispatch.gates(_config(spark, sf_dir), _state(spark, sf_dir), v.NOW).select(
        "feed_key", "feed_sub_key", "gate_active", "gate_auto", "gate_hold", "gate_due", "eligible")


@query(v.sql("config", "SELECT feed_key, feed_sub_key, gate_due FROM v_plan", _GATES))
def dispatch_due(spark, sf_dir):
    return dispatch.gates(_config(spark, sf_dir), _state(spark, sf_dir), v.NOW, False, False).select("feed_key", "feed_sub_key", "gate_due")


def _plan(spark, sf_dir):
    return dispatch.plan(dispatch.gates(_config(spark, sf_dir), _state(spark, sf_dir), v.NOW), _active(spark, sf_dir))


@query(v.sql("config", """
SELECT feed_key, feed_sub_key, CASE WHEN eligible AND NOT busy THEN 'TRIGGER' ELSE 'SKIPPED' END AS decision,
  CASE WHEN NOT eligible THEN 'row not eligible' WHEN busy THEN 'active ingestion run already exists for feed_key=' || feed_key END AS reason
FROM v_plan""", _GATES))
def dispatch_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("feed_key", "feed_sub_key", "decision", "reason")


@query(v.sql("config", f"""
SELECT coalesce(t.feed_key, s.feed_key) AS feed_key, coalesce(t.feed_sub_key, s.feed_sub_key) AS feed_sub_key,
  CASE WHEN t.feed_key IS NULL THEN s.last_dispatched_at ELSE TIMESTAMP '{v.NOW}' END AS last_dispatched_at,
  CASE WHEN t.feed_key IS NULL THEN s.next_dispatched_at ELSE n.f END AS next_dispatched_at,
  CASE WHEN t.feed_key IS NULL THEN s.dispatch_run_id ELSE 'run_new' END AS dispatch_run_id
FROM (SELECT * FROM v_plan WHERE eligible AND NOT busy) t FULL JOIN v_state s ON t.feed_key = s.feed_key AND t.feed_sub_key = s.feed_sub_key
LEFT JOIN (""" + _fire("v_nasks", "local") + """) n ON n.k = t.feed_key || '/' || t.feed_sub_key""", _GATES + f""",
v_nasks AS (SELECT feed_key || '/' || feed_sub_key AS k, trim(expr) AS expr, TIMESTAMP '{v.NOW}' AS local, DATE '1998-12-01' AS d
  FROM (SELECT feed_key, feed_sub_key, unnest(string_split(sched_cron, '|')) AS expr FROM v_plan WHERE eligible AND NOT busy))"""))
def merge_dispatch_state(spark, sf_dir):
    return dispatch.merge_state(_state(spark, sf_dir), _plan(spark, sf_dir), v.NOW, "run_new")


@query(v.sql("config", """SELECT feed_key, feed_sub_key, CASE WHEN feed_key <> 'feed_1' THEN last_dispatched_at END AS last_dispatched_at,
  CASE WHEN feed_key <> 'feed_1' THEN next_dispatched_at END AS next_dispatched_at FROM v_state""", _STATE))
def reset_dispatch(spark, sf_dir):
    return dispatch.reset_state(_state(spark, sf_dir), "feed_1").select("feed_key", "feed_sub_key", "last_dispatched_at", "next_dispatched_at")


@query(v.sql("config", "SELECT feed_key, feed_sub_key FROM v_config WHERE ctl_active = 'Y' AND feed_sub_key = 'DEFAULT'"))
def never_dispatched(spark, sf_dir):
    return dispatch.never_dispatched(_config(spark, sf_dir), _state(spark, sf_dir)).select("feed_key", "feed_sub_key")


@query(v.sql("config", f"""
SELECT feed_key, feed_sub_key, next_dispatched_at, (date_diff('second', next_dispatched_at, TIMESTAMP '{v.NOW}') // 60)::BIGINT AS minutes_overdue
FROM v_state WHERE next_dispatched_at < TIMESTAMP '{v.NOW}'""", _STATE))
def overdue_feeds(spark, sf_dir):
    return dispatch.overdue(_state(spark, sf_dir), v.NOW).select("feed_key", "feed_sub_key", "next_dispatched_at", "minutes_overdue")
