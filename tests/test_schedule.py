"""Fire times: every kind of schedule, edges, zones, alternatives, due test and gates."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedyard.operators import dispatch, schedule

REF = "2026-05-04 14:03:27"  # a Monday

# Schedule, reference time, expected next fire.
CASES = [
    ("0 */5 * * * ?", REF, "2026-05-04 14:05:00"), ("0 */5 2-23 * * ?", REF, "2026-05-04 14:05:00"),
    ("0 */10 * * * ?", REF, "2026-05-04 14:10:00"), ("0 */15 2-23 * * ?", REF, "2026-05-04 14:15:00"),
    ("0 */15 9-17 ? * MON-FRI", REF, "2026-05-04 14:15:00"), ("0 */30 2-23 * * ?", REF, "2026-05-04 14:30:00"),
    ("0 */5 * ? * SAT,SUN", REF, "2026-05-09 00:00:00"), ("0 */5 * ? * MON,WED,FRI", REF, "2026-05-04 14:05:00"),
    ("0 */5 2-23 ? * MON,WED,FRI", REF, "2026-05-04 14:05:00"), ("0 0 * * * ?", REF, "2026-05-04 15:00:00"),
    ("0 0 */2 * * ?", REF, "2026-05-04 16:00:00"), ("0 0 6-22/2 * * ?", REF, "2026-05-04 16:00:00"),
    ("0 0 */3 * * ?", REF, "2026-05-04 15:00:00"), ("0 0 */4 * * ?", REF, "2026-05-04 16:00:00"),
    ("0 0 */6 * * ?", REF, "2026-05-04 18:00:00"), ("0 0 2/6 * * ?", REF, "2026-05-04 20:00:00"),
    ("0 0 2-23 * * ?", REF, "2026-05-04 15:00:00"), ("0 0 * ? * SAT,SUN", REF, "2026-05-09 00:00:00"),
    ("0 0 * ? * MON,WED,FRI", REF, "2026-05-04 15:00:00"), ("0 0 2-23 ? * MON,WED,FRI", REF, "2026-05-04 15:00:00"),
    ("0 30 5 * * ?", REF, "2026-05-05 05:30:00"), ("0 30 5,17 * * ?", REF, "2026-05-04 17:30:00"),
    ("0 0 6,12,18 * * ?", REF, "2026-05-04 18:00:00"), ("0 30 5 ? * MON-FRI", REF, "2026-05-05 05:30:00"),
    ("0 30 5,17 ? * MON-FRI", REF, "2026-05-04 17:30:00"), ("0 0 6/2 ? * MON,WED", REF, "2026-05-04 16:00:00"),
    ("0 0 8 ? * MON", REF, "2026-05-11 08:00:00"), ("0 0 8,20 ? * MON", REF, "2026-05-04 20:00:00"),
    ("0 0 8 ? * TUE,THU", REF, "2026-05-05 08:00:00"), ("0 0 8,20 ? * MON,WED,FRI", REF, "2026-05-04 20:00:00"),
    ("0 0 8 1 * ?", REF, "2026-06-01 08:00:00"), ("0 0 8 L * ?", REF, "2026-05-31 08:00:00"),
    ("0 0 8 ? * 3#2", REF, "2026-05-12 08:00:00"), ("0 0 8 15W * ?", REF, "2026-05-15 08:00:00"),
    ("0 0 8 1,15 * ?", REF, "2026-05-15 08:00:00"), ("0 0 8-23 1,15 * ?", REF, "2026-05-15 08:00:00"),
    ("0 0 8-23 15 * ?", REF, "2026-05-15 08:00:00"), ("0 0 0 1 1,4,7,10 ?", REF, "2026-07-01 00:00:00"),
    ("0 0 0 L 3,6,9,12 ?", REF, "2026-06-30 00:00:00"), ("0 0 8-23 1 1,4,7,10 ?", REF, "2026-07-01 08:00:00"),
    ("0 0 8-23 L 3,6,9,12 ?", REF, "2026-06-30 08:00:00"), ("0 0 0 1 1 ?", REF, "2027-01-01 00:00:00"),
    ("0 0 0 31 12 ?", REF, "2026-12-31 00:00:00"), ("0 0 8-23 1 1 ?", REF, "2027-01-01 08:00:00"),
    ("0 0 8-23 31 12 ?", REF, "2026-12-31 08:00:00"),
    # week steps
    ("0 0 8 ? * 2/2", REF, "2026-05-11 08:00:00"), ("0 0 8 ? * 2/2+1", REF, "2026-05-18 08:00:00"),
    ("0 0 8 ? * 6/3", REF, "2026-05-22 08:00:00"), ("0 0 8 ? * 3/2", REF, "2026-05-12 08:00:00"), ("0 0 20 ? * 2/2", REF, "2026-05-11 20:00:00"),
    # boundaries
    ("0 0 * * * ?", "2026-05-04 23:59:30", "2026-05-05 00:00:00"), ("0 0 * * * ?", "2026-05-31 23:30:00", "2026-06-01 00:00:00"),
    ("0 0 8 1 * ?", "2026-12-31 23:30:00", "2027-01-01 08:00:00"), ("0 0 8 L * ?", "2028-02-01 00:00:00", "2028-02-29 08:00:00"),
    ("0 0 8 L * ?", "2025-02-01 00:00:00", "2025-02-28 08:00:00"), ("0 0 * * * ?", "2026-05-04 14:00:00", "2026-05-04 15:00:00"),
    ("0 0 8 ? * MON", "2026-05-05 10:00:00", "2026-05-11 08:00:00"), ("0 0 2-23 * * ?", "2026-05-04 01:00:00", "2026-05-04 02:00:00"),
    ("0 0 2-22/2 * * ?", "2026-05-04 23:30:00", "2026-05-05 02:00:00"), ("0 0 0 1 JAN,APR,JUL,OCT ?", REF, "2026-07-01 00:00:00"),
    ("0 0 0 29 2 ?", REF, "2028-02-29 00:00:00"), ("15,45 0 0 * * ?", "2026-05-04 00:00:15", "2026-05-04 00:00:45"),
    # day operators
    ("0 0 8 LW * ?", REF, "2026-05-29 08:00:00"), ("0 0 8 L-3 * ?", REF, "2026-05-28 08:00:00"), ("0 0 8 16W * ?", REF, "2026-05-15 08:00:00"),
    ("0 0 8 17W * ?", REF, "2026-05-18 08:00:00"), ("0 0 8 1W 8 ?", REF, "2026-08-03 08:00:00"), ("0 0 8 31W 5 ?", REF, "2026-05-29 08:00:00"),
    ("0 0 8 ? * 6L", REF, "2026-05-29 08:00:00"), ("0 0 8 ? 2 2#5", REF, None), ("0 0 8 10 * SAT", REF, "2026-05-09 08:00:00"),
    # alternatives
    ("0 30 7 * * ? | 0 0 11 * * ? | 0 45 16 * * ?", REF, "2026-05-04 16:45:00"), ("0 0 6 * * ? | 0 0 18 * * ?", REF, "2026-05-04 18:00:00"),
    ("0 0 6 * * ? | 0 0 12 * * ? | 0 0 18 * * ?", "2026-05-04 23:00:00", "2026-05-05 06:00:00"), ("bad expr | 0 0 18 * * ?", REF, "2026-05-04 18:00:00"),
    # invalid
    ("*/5 * * * *", REF, None), ("", REF, None), ("0 0 0 1 1 ? 2026", REF, None), ("0 0 0 30 2 ?", REF, None), ("0 x 8 * * ?", REF, None), ("0 0 8 ? * 2/0", REF, None),
    ("0 */0 8 * * ?", REF, None), (None, REF, None), ("0 0 * * * ?", None, None),
]


def _ts(text):
    return datetime.fromisoformat(text) if text else None


def test_catalogue_of_schedules(spark):
    df = spark.createDataFrame([(i, c, _ts(a)) for i, (c, a, _) in enumerate(CASES)], "i int, cron string, after timestamp")
    got = {r["i"]: r["f"] for r in schedule.next_fire(df, "cron", None, "after", "f").collect()}
    wrong = [(CASES[i], got[i]) for i in range(len(CASES)) if got[i] != _ts(CASES[i][2])]
    assert not wrong


def test_time_zones(spark):
    cases = [
        ("0 0 * * * ?", "America/New_York", "2026-05-04 14:03:27", "2026-05-04 15:00:00"),
        ("0 30 5 * * ?", "America/New_York", "2026-05-04 14:03:27", "2026-05-05 09:30:00"),
        ("0 0 0 * * ?", " ", "2026-05-04 14:03:27", "2026-05-05 00:00:00"),
        # the hour before and after the autumn change share a wall clock; the fire must still be later
        ("0 */15 * * * ?", "America/New_York", "2026-11-01 06:30:00", "2026-11-01 07:00:00"),
        ("0 0 3 * * ?", "America/New_York", "2026-03-08 06:30:00", "2026-03-08 07:00:00"),
    ]
    df = spark.createDataFrame([(i, c, z, _ts(a)) for i, (c, z, a, _) in enumerate(cases)], "i int, cron string, tz string, after timestamp")
    got = {r["i"]: r["f"] for r in schedule.next_fire(df, "cron", "tz", "after", "f").collect()}
    assert [got[i] for i in range(len(cases))] == [_ts(c[3]) for c in cases]


def test_next_fire_is_strictly_later_for_many(spark):
    df = spark.range(2000).select(
        F.element_at(F.array(*[F.lit(c) for c, _, f in CASES if f]), (F.pmod("id", F.lit(40)) + 1).cast("int")).alias("cron"),
        (F.lit("2024-02-27").cast("timestamp") + F.make_dt_interval(secs=(F.col("id") * 7919).cast("int"))).alias("after"))
    bad = schedule.next_fire(df, "cron", None, "after", "f").filter("f <= after OR f IS NULL")
    assert bad.count() == 0


@pytest.mark.parametrize("field,low,high,want", [
    ("*", 0, 3, [0, 1, 2, 3]), ("?", 1, 3, [1, 2, 3]), ("5", 0, 59, [5]), ("1,3,5", 1, 7, [1, 3, 5]), ("2-5", 0, 23, [2, 3, 4, 5]),
    ("*/20", 0, 59, [0, 20, 40]), ("2/6", 0, 23, [2, 8, 14, 20]), ("8-22/7", 0, 23, [8, 15, 22]), ("9-3", 0, 23, []),
    ("L", 1, 31, None), ("15W", 1, 31, None), ("2#3", 1, 7, None), ("0-99999999", 0, 2, [0, 1, 2]), ("a", 0, 9, None),
])
def test_field_values(spark, field, low, high, want):
    row = spark.range(1).select(schedule.field_values(F.lit(field), low, high).alias("v")).first()
    assert row["v"] == want


def _row(cron="0 0 * * * ?", last="2026-05-04 14:00:00", active="Y", auto="Y", hold="", tz="UTC"):
    return ("f", "DEFAULT", active, auto, hold, cron, tz), ("f", "DEFAULT", _ts(last))


@pytest.mark.parametrize("row,now,want", [
    (_row(), "2026-05-04 15:01:00", True), (_row(), "2026-05-04 14:30:00", False), (_row(), "2026-05-04 15:00:00", True),
    (_row(cron=""), "2026-05-04 15:01:00", False), (_row(cron=None), "2026-05-04 15:01:00", False), (_row(last=None), "2026-05-04 14:00:00", True),
    (_row(active="N"), "2026-05-04 15:01:00", False), (_row(auto="n"), "2026-05-04 15:01:00", False),
    (_row(hold="2026-05-05T00:00:00Z"), "2026-05-04 15:01:00", False), (_row(hold="2026-05-04"), "2026-05-04 15:01:00", True),
    (_row(hold="whenever"), "2026-05-04 15:01:00", True), (_row(active=None, auto=None), "2026-05-04 15:01:00", True),
    (_row(last="2026-05-04 15:00:00", tz="America/New_York"), "2026-05-04 15:30:00", False),
    (_row(last="2026-05-04 15:00:00", tz="America/New_York"), "2026-05-04 16:01:00", True),
    (_row(cron="bad", last=None), "2026-05-04 15:01:00", True), (_row(cron="bad"), "2026-05-04 15:01:00", False),
])
def test_gates(spark, row, now, want):
    config = spark.createDataFrame([row[0]], "feed_key string, feed_sub_key string, ctl_active string, ctl_auto_trigger string, "
                                             "ctl_maintenance_hold_until string, sched_cron string, sched_timezone string")
    state = spark.createDataFrame([row[1]], "feed_key string, feed_sub_key string, last_dispatched_at timestamp")
    assert dispatch.gates(config, state, now).first()["eligible"] is want


def test_flags_not_honoured_and_plan_and_state(spark):
    (c, s) = _row(auto="N", hold="2026-12-31T00:00:00Z")
    config = spark.createDataFrame([c, ("busy",) + _row()[0][1:], ("off",) + _row(active="N")[0][1:]],
                                   "feed_key string, feed_sub_key string, ctl_active string, ctl_auto_trigger string, "
                                   "ctl_maintenance_hold_until string, sched_cron string, sched_timezone string")
    state = spark.createDataFrame([(*s, None, "old")], "feed_key string, feed_sub_key string, last_dispatched_at timestamp, next_dispatched_at timestamp, dispatch_run_id string")
    gated = dispatch.gates(config, state, "2026-05-04 15:01:00", honor_auto_trigger=False, honor_hold=False)
    plan = dispatch.plan(gated, spark.createDataFrame([("busy",)], "feed_key string"))
    got = {r["feed_key"]: (r["decision"], r["reason"]) for r in plan.collect()}
    assert got == {"f": ("TRIGGER", None), "busy": ("SKIPPED", "active ingestion run already exists for feed_key=busy"), "off": ("SKIPPED", "row not eligible")}
    new = dispatch.merge_state(state, plan, "2026-05-04 15:01:00", "run").collect()
    assert [(r["feed_key"], r["last_dispatched_at"], r["next_dispatched_at"], r["dispatch_run_id"]) for r in new] == [
        ("f", _ts("2026-05-04 15:01:00"), _ts("2026-05-04 16:00:00"), "run")]
