"""Fire times of six-field schedules, computed as a join with a fire calendar.

Schedules are rows, not programs: each distinct expression is spread over the days it may fire on,
with its times of day as three bit masks. A request then needs one equi-join on (expression, day).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Names and their numbers (Sunday is day 1), and the search horizon.
DAY_NUMBERS = {"SUN": 1, "MON": 2, "TUE": 3, "WED": 4, "THU": 5, "FRI": 6, "SAT": 7}
MONTH_NUMBERS = {"JAN": 1, "FEB": 2, "MAR": 3, "APR": 4, "MAY": 5, "JUN": 6,
                 "JUL": 7, "AUG": 8, "SEP": 9, "OCT": 10, "NOV": 11, "DEC": 12}
HORIZON_DAYS = 4 * 366


def _numbered(field: Column, names: dict[str, int]) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(str(kv[1]))), names.items(), field)


def _range(first: Column, last: Column, step: Column) -> Column:
    return F.when(step <= 0, F.lit(None)).when(first > last, F.array().cast("array<int>")).otherwise(F.sequence(first, last, step))


def field_values(field: Column, low: int, high: int) -> Column:
    """Sorted values within ``low..high`` of a plain field: ``*``, ``?``, lists, ranges and steps.

    NULL when any part is malformed or holds a day operator.
    """
    lo, hi, one = F.lit(low), F.lit(high), F.lit(1)

    def part_values(part: Column) -> Column:
        p = F.trim(part)
        base, step = F.split_part(p, F.lit("/"), F.lit(1)), F.split_part(p, F.lit("/"), F.lit(2)).try_cast("int")
        first = F.split_part(base, F.lit("-"), F.lit(1)).try_cast("int")
        last = F.least(F.split_part(base, F.lit("-"), F.lit(2)).try_cast("int"), hi)
        return (
            F.when(p.rlike(r"^\d+$"), F.array(p.try_cast("int")))
            .when(p.rlike(r"^\d+-\d+$"), _range(first, last, one))
            .when(p.rlike(r"^[*?]/\d+$"), _range(lo, hi, step))
            .when(p.rlike(r"^\d+/\d+$"), _range(first, hi, step))
            .when(p.rlike(r"^\d+-\d+/\d+$"), _range(first, last, step))
        )

    parts = F.transform(F.split(field, ","), part_values)
    bad = F.exists(parts, lambda x: x.isNull())
    values = F.array_sort(F.array_distinct(F.flatten(parts)))
    return F.when(F.trim(field).isin("*", "?"), F.sequence(lo, hi)).when(~bad, F.filter(values, lambda x: (x >= lo) & (x <= hi)))


def bit_mask(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(_shift_left(x)))


def _shift_left(by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), by)


def _lowest(mask: Column) -> Column:
    """Index of the lowest set bit."""
    return F.bit_count(mask.bitwiseAND(-mask) - 1)


def _next_bit(mask: Column, after: Column) -> Column:
    rest = F.call_function("shiftright", mask, after + 1)
    return F.when(rest != 0, after + 1 + _lowest(rest))


def _has_bit(mask: Column, bit: Column) -> Column:
    return F.call_function("shiftright", mask, bit).bitwiseAND(F.lit(1).cast("bigint")) == 1


def split_expressions(expression: Column) -> Column:
    """The alternatives of a piped expression, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(expression, r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def parse_expressions(df: DataFrame, expression: str = "expr") -> DataFrame:
    """Add typed fields and ``cron_valid``; anything but six well-formed fields is invalid.

    The day fields become a kind with its numbers, so that testing a day is plain arithmetic.
    """
    parts = F.split(F.trim(F.col(expression)), r"\s+")
    out = df.withColumn("_f", F.transform(parts, lambda x: F.upper(x)))

    def field(i: int) -> Column:
        return F.get("_f", F.lit(i))

    def number(pattern: str, name: str) -> Column:
        return F.regexp_extract(name, pattern, 1).try_cast("int")

    out = out.withColumns({"dom": field(3), "month": _numbered(field(4), MONTH_NUMBERS), "dow": _numbered(field(5), DAY_NUMBERS)})
    dom, dow = F.col("dom"), F.col("dow")
    out = out.withColumns({
        "dom_kind": F.when(dom.isin("*", "?"), "ALL").when(dom == "L", "LAST").when(dom == "LW", "LAST_WEEKDAY")
        .when(dom.rlike(r"^L-\d+$"), "BEFORE_LAST").when(dom.rlike(r"^[1-9]\d*W$"), "NEAR_WEEKDAY").otherwise("LIST"),
        "dom_n": F.coalesce(number(r"^L-(\d+)$", "dom"), number(r"^(\d+)W$", "dom")),
        "dow_kind": F.when(dow.isin("*", "?"), "ALL").when(dow.rlike(r"^\dL$"), "LAST").when(dow.rlike(r"^\d#\d$"), "NTH")
        .when(dow.rlike(r"^\d/\d+([+]\d+)?$"), "WEEK_STEP").otherwise("LIST"),
        # weekday numbers wrap around, so 8 is Sunday and 0 is Saturday
        "dow_q": F.pmod(number(r"^(\d)", "dow") - 1, F.lit(7)) + 1,
        "dow_n": F.coalesce(number(r"^\d#(\d)$", "dow"), number(r"^\d/(\d+)", "dow")),
        "dow_off": F.coalesce(number(r"[+](\d+)$", "dow"), F.lit(0)),
    })
    none = F.array().cast("array<int>")
    weekdays = F.when(dow.rlike("^[*?]/"), field_values(dow, 1, 7)).otherwise(
        F.transform(field_values(dow, 0, 9), lambda x: F.pmod(x - 1, F.lit(7)) + 1))
    out = out.withColumns({
        "seconds": F.when(field(0).rlike("[L#W]"), F.array(F.lit(0))).otherwise(field_values(field(0), 0, 59)),
        "minutes": field_values(field(1), 0, 59),
        "hours": field_values(field(2), 0, 23),
        "months": field_values(F.col("month"), 1, 12),
        "dom_days": F.when(dom.rlike("[LW#]"), none).otherwise(field_values(dom, 1, 31)),
        "dow_days": F.when(F.col("dow_kind") == "LIST", weekdays).otherwise(none),
    })
    lists = [F.col(c).isNotNull() for c in ("seconds", "minutes", "hours", "months", "dom_days", "dow_days")]
    stepped = (F.col("dow_kind") != "WEEK_STEP") | (F.col("dow_n") > 0)
    valid = reduce(lambda x, y: x & y, lists, (F.size("_f") == 6) & stepped)
    seconds = F.when(F.size("seconds") > 0, F.col("seconds")).otherwise(F.array(F.lit(0)))
    return out.withColumns({
        "cron_valid": F.coalesce(valid, F.lit(False)),
        "sec_mask": bit_mask(seconds), "min_mask": bit_mask(F.col("minutes")), "hour_mask": bit_mask(F.col("hours")),
    }).drop("_f")


def _with_firing(days: DataFrame) -> DataFrame:
    """Add ``fires`` to rows of a parsed expression and a ``day``."""
    day = F.col("day")
    out = days.withColumns({
        "_d": F.dayofmonth(day), "_q": F.dayofweek(day), "_last": F.dayofmonth(F.last_day(day)), "_last_q": F.dayofweek(F.last_day(day)),
        "_near": F.least("dom_n", F.dayofmonth(F.last_day(day))),
    }).withColumn("_near_q", F.pmod(F.col("_q") - 1 + F.col("_near") - F.col("_d"), F.lit(7)) + 1)
    d, last, near, kind = F.col("_d"), F.col("_last"), F.col("_near"), F.col("dom_kind")
    weekday = (
        F.when(F.col("_near_q") == 7, F.when(near > 1, near - 1).otherwise(near + 2))
        .when(F.col("_near_q") == 1, F.when(near < last, near + 1).otherwise(near - 2))
        .otherwise(near)
    )
    by_dom = (
        F.when(kind == "ALL", True).when(kind == "LAST", d == last)
        .when(kind == "LAST_WEEKDAY", d == last - F.when(F.col("_last_q") == 7, 1).when(F.col("_last_q") == 1, 2).otherwise(0))
        .when(kind == "BEFORE_LAST", d == F.greatest(last - F.col("dom_n"), F.lit(1)))
        .when(kind == "NEAR_WEEKDAY", d == weekday)
        .otherwise(F.array_contains("dom_days", d))
    )
    q, n, dow_kind = F.col("_q"), F.col("dow_n"), F.col("dow_kind")
    same = q == F.col("dow_q")
    by_dow = (
        F.when(dow_kind == "ALL", True).when(dow_kind == "LAST", same & (d > last - 7))
        .when(dow_kind == "NTH", same & (F.floor((d - 1) / 7) + 1 == n))
        .when(dow_kind == "WEEK_STEP", same & (F.weekofyear(day) % n == F.col("dow_off") % n))
        .otherwise(F.array_contains("dow_days", q))
    )
    out = out.withColumns({"_by_dom": by_dom, "_by_dow": by_dow})
    # two restricted day fields match on either; otherwise the restricted one decides
    either = (kind != "ALL") & (dow_kind != "ALL")
    hit = F.when(either, F.col("_by_dom") | F.col("_by_dow")).otherwise(F.col("_by_dom") & F.col("_by_dow"))
    return out.withColumn("fires", F.coalesce(F.array_contains("months", F.month(day)) & hit, F.lit(False))).drop(
        "_d", "_q", "_last", "_last_q", "_near", "_near_q", "_by_dom", "_by_dow")


def firing_days(spans: DataFrame) -> DataFrame:
    """Every day of each ``(expr, first_day, last_day)`` with whether the expression fires on it.

    Invalid expressions have no days.
    """
    parsed = parse_expressions(spans)
    return _with_firing(parsed.withColumn("day", F.explode(F.when(F.col("cron_valid"), F.sequence("first_day", "last_day")))))


def calendar(spans: DataFrame) -> DataFrame:
    """Firing days with the next later firing day, and the times of day as masks."""
    later = Window.partitionBy("expr").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    return firing_days(spans).select(
        "expr", "day", "fires", F.min(F.when(F.col("fires"), F.col("day"))).over(later).alias("next_day"),
        "sec_mask", "min_mask", "hour_mask",
    )


def _with_fire(rows: DataFrame) -> DataFrame:
    """Add ``_fire``, the first local fire after ``_local``: later on the same day, else at the start of the next one."""
    sec, mins, hours = F.col("sec_mask"), F.col("min_mask"), F.col("hour_mask")
    out = rows.withColumns({
        "_h": F.hour("_local"), "_m": F.minute("_local"), "_s": F.second("_local"),
        "_s0": _lowest(sec), "_m0": _lowest(mins), "_h0": _lowest(hours), "_has": (mins != 0) & (hours != 0),
    })
    h, m, s = F.col("_h"), F.col("_m"), F.col("_s")
    out = out.withColumns({
        "_s1": F.when(_has_bit(hours, h) & _has_bit(mins, m), _next_bit(sec, s)),
        "_m1": F.when(_has_bit(hours, h), _next_bit(mins, m)), "_h1": _next_bit(hours, h),
    })
    today = F.coalesce(
        h * 3600 + m * 60 + F.col("_s1"), h * 3600 + F.col("_m1") * 60 + F.col("_s0"),
        F.col("_h1") * 3600 + F.col("_m0") * 60 + F.col("_s0"))
    first = F.col("_h0") * 3600 + F.col("_m0") * 60 + F.col("_s0")
    out = out.withColumn("_today", F.when(F.col("_has") & F.col("fires"), today))
    fire_day = F.when(F.col("_today").isNotNull(), F.col("day")).otherwise(F.col("next_day"))
    at = fire_day.cast("timestamp") + F.make_dt_interval(secs=F.coalesce("_today", first))
    return out.withColumn("_fire", F.when(F.col("_has"), at))


def next_fire(requests: DataFrame, cron: str = "sched_cron", tz: str | None = None, after: str = "after",
              out: str = "next_fire") -> DataFrame:
    """Add the first fire time strictly after ``after``, NULL when there is none within four years.

    With ``tz`` the schedule is read in that zone and the result converted back; in the repeated
    hour of an autumn change the result is still later than ``after``.

    Schedules fire on whole seconds, so equal questions per second are asked once. That also bounds
    the rows per (expression, day) by the seconds of a day and the zones in use, however many
    requests share one schedule. Answers are joined back by question; they are few, and beyond
    broadcast size the adaptive skew join splits a question that very many rows ask.
    """
    zone = F.coalesce(F.nullif(F.trim(F.col(tz)), F.lit("")), F.lit("UTC")) if tz else F.lit("UTC")
    asked = requests.withColumns({"_cron": F.col(cron), "_tz": zone, "_after": F.date_trunc("second", F.col(after).cast("timestamp"))})
    asks = asked.filter("_cron IS NOT NULL AND _after IS NOT NULL").select("_cron", "_tz", "_after").distinct()
    local = F.from_utc_timestamp("_after", F.col("_tz"))
    # the end of the local hour is tried as well: in a repeated hour the first try may lie in the past
    hour_end = F.date_trunc("hour", local) + F.make_dt_interval(mins=F.lit(59), secs=F.lit(59))
    tries = F.when(F.col("_tz") == "UTC", F.array(local)).otherwise(F.array(local, hour_end))
    each = asks.select("*", F.explode(split_expressions(F.col("_cron"))).alias("expr")).select(
        "*", F.explode(tries).alias("_local")).withColumn("day", F.to_date("_local"))
    spans = each.groupBy("expr").agg(F.min("day").alias("first_day"), F.date_add(F.max("day"), HORIZON_DAYS).alias("last_day"))
    fires = _with_fire(each.join(calendar(spans), ["expr", "day"])).withColumn("_utc", F.to_utc_timestamp("_fire", F.col("_tz")))
    in_reach = F.col("_utc").between(F.col("_after") + F.make_dt_interval(secs=F.lit(1)), F.col("_after") + F.make_dt_interval(days=F.lit(HORIZON_DAYS)))
    fire = F.col("_utc")
    answers = fires.groupBy("_cron", "_tz", "_after").agg(F.min(F.when(in_reach, fire)).alias(out))
    return asked.join(answers, ["_cron", "_tz", "_after"], "left").select(*requests.columns, out)


def is_due(cron: Column, last: Column, fire: Column, now: Column) -> Column:
    """Blank schedules are never due, undispatched feeds always, others once their next fire has passed."""
    return (
        F.when(F.coalesce(F.trim(cron), F.lit("")) == "", False)
        .when(last.isNull(), True)
        .otherwise(F.coalesce(now >= fire, F.lit(False)))
    )
