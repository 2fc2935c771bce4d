"""Metadata captured from file names."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedyard.functions.text import strip

# Capture targets with their types, and the reasons of a failed parse.
CAPTURE_TARGETS = {
    "vendor_code": "string",
    "lob_code": "string",
    "file_date": "date",
    "file_part_seq": "int",
    "file_part_tot": "int",
    "file_version_label": "string",
    "file_extension": "string",
}
REASON_NO_MATCH = "filename does not match configured regex"
REASON_BAD_DATE = "invalid file_date"

_SEP = "\x1f"
# Up to this many sub keys of a feed are tried one after the other; rows of feeds with more are multiplied by them.
SUB_KEYS_IN_PLACE = 8


def version_rank(label: Column) -> Column:
    """``updated`` is 1, ``v<digits>`` its number, everything else 0."""
    text = F.lower(strip(label))
    return (
        F.when(text == "updated", F.lit(1))
        .when(text.rlike("^v[0-9]+$"), F.coalesce(F.substr(text, F.lit(2)).try_cast("int"), F.lit(0)))
        .otherwise(F.lit(0))
    )


def check_regex(regex: str) -> str:
    """Feed regexes use Python syntax; convert named groups and refuse what Java cannot match alike."""
    re.compile(regex)
    if re.search(r"\(\?P=|\(\?\(|\\Z", regex):
        raise ValueError(f"regex cannot be converted: {regex!r}")
    return regex.replace("(?P<", "(?<")


def read_capture_spec(spec: str) -> dict[str, tuple[int, str]]:
    """``idx|column|type;...`` to ``{column: (idx, type)}``."""
    out = {}
    for token in (t.strip() for t in spec.split(";")):
        if token:
            index, column, kind = token.split("|", 2)
            out[column] = (int(index), kind)
    return out


def name_pattern(regex: str | Column) -> Column:
    """The whole-name form of a feed regex: it starts at the first character and ignores case."""
    body = F.lit(check_regex(regex)) if isinstance(regex, str) else F.replace(regex, F.lit("(?P<"), F.lit("(?<"))
    return F.concat(F.lit("(?ius)^(?:"), body, F.lit(").*$"))


def name_template(spec: str | Column) -> Column:
    """Replacement text naming one regex group per capture target."""
    if isinstance(spec, str):
        known = read_capture_spec(spec)
        return F.lit(_SEP.join(f"${known[t][0]}" if t in known else "" for t in CAPTURE_TARGETS))
    refs = []
    for t in CAPTURE_TARGETS:
        index = F.regexp_extract(spec, rf"(?:^|;)\s*(\d+)\|{t}\|", 1)
        refs.append(F.when(index != "", F.concat(F.lit("$"), index)).otherwise(F.lit("")))
    return F.concat_ws(_SEP, *refs)


def name_rules(config: DataFrame) -> DataFrame:
    """Per feed, and sub key where there are any, the pattern and template, worked out on the configuration before it meets any file."""
    sub = ["feed_sub_key"] if "feed_sub_key" in config.columns else []
    return config.select("feed_key", *sub, name_pattern(F.col("src_file_regex")).alias("name_pattern"),
                         name_template(F.col("src_file_capture_spec")).alias("name_template"))


def parse_by_config(df: DataFrame, config: DataFrame, keys: list[str], how: str = "inner", together: bool = False,
                    only: tuple[str, ...] = ()) -> DataFrame:
    """Parse names by the rules of their feed in ``config``; one row per ``keys``, which name the rows of ``df``.

    ``together`` says that rows of a feed lie together, so that they need no sort. With ``only`` no other columns than these and the keys are
    kept, so that no others travel where sub keys are told apart.

    A feed may have several sub keys, each with a pattern: a file is of the first, by name, whose pattern it fits, and of the
    first where it fits none. ``feed_sub_key`` says which.
    """
    rules = name_rules(config)
    nth = Window.partitionBy("feed_key").orderBy(F.coalesce("feed_sub_key", F.lit("")))
    ranked = rules.withColumn("_nth", F.row_number().over(nth)) if "feed_sub_key" in rules.columns else rules
    most = (ranked.agg(F.max("_nth")).first()[0] or 1) if "_nth" in ranked.columns else 1
    if 1 < most <= SUB_KEYS_IN_PLACE:
        parsed = _parse_in_place(df, ranked, most, how, together)
    else:
        parsed = parse_by_rules(df.join(rules, "feed_key", how), together=together and most == 1)
    if only:
        parsed = parsed.select(*keys, *[c for c in (*only, "feed_sub_key", "parse_status") if c in parsed.columns])
    if most <= SUB_KEYS_IN_PLACE:
        return parsed
    rest = F.struct(*[F.col(c) for c in parsed.columns if c not in keys])
    order = F.struct(F.col("parse_status") != "PARSED", F.coalesce("feed_sub_key", F.lit("")))
    return parsed.groupBy(*keys).agg(F.min_by(rest, order).alias("_own")).select(*keys, "_own.*")


def _parse_in_place(df: DataFrame, ranked: DataFrame, most: int, how: str, together: bool) -> DataFrame:
    """Try the sub keys of each row's feed one after the other: rows are neither multiplied nor shuffled, and names that fit are not tried again."""
    none = F.col("_own").isNull() | (F.col("_own.parse_status") != "PARSED")
    rows = df
    for n in range(1, most + 1):
        rule = ranked.filter(F.col("_nth") == n).drop("_nth")
        met = rows.join(rule, "feed_key", how if n == 1 else "left")
        if n > 1:
            met = met.withColumn("name_pattern", F.when(none, F.col("name_pattern")))
        tried = parse_by_rules(met, together=together or n > 1)
        found = F.struct(*[F.col(c) for c in tried.columns if c not in rows.columns])
        own = found if n == 1 else F.when(none & (F.col("parse_status") == "PARSED"), found).otherwise(F.col("_own"))
        rows = tried.select(*df.columns, own.alias("_own"))
    return rows.select(*df.columns, "_own.*")


def parse_filename(df: DataFrame, regex: str, capture_spec: str,
                   file_name: str = "file_name", feed_key: str = "feed_key") -> DataFrame:
    """Parse the names of one feed; see :func:`parse_by_rules`."""
    rules = {"name_pattern": name_pattern(regex), "name_template": name_template(capture_spec)}
    return _parse(df, rules["name_pattern"], rules["name_template"], file_name, feed_key)


def parse_by_rules(df: DataFrame, file_name: str = "file_name", feed_key: str = "feed_key", together: bool = False) -> DataFrame:
    """Parse names of many feeds; rows carry ``name_pattern`` and ``name_template`` of their feed.

    Adds capture columns, parse status, version rank and group keys. The regex runs once per row:
    the whole name is rewritten to its captured groups, which are then split apart. Since a regex is
    compiled whenever it differs from that of the row before, rows of one pattern go together, by a sort unless they do already.
    """
    grouped = df if together else df.withColumn("_rule", F.xxhash64("name_pattern")).sortWithinPartitions("_rule")
    return _parse(grouped, F.col("name_pattern"), F.col("name_template"), file_name, feed_key).drop(
        "_rule", "name_pattern", "name_template")


def _parse(df: DataFrame, pattern: Column, template: Column, file_name: str, feed_key: str) -> DataFrame:
    groups = F.split(F.regexp_replace(F.col(file_name), pattern, template), _SEP)
    # generated rather than projected: a filter on parse results must not be pushed below and repeat the regex
    out = df.select("*", F.explode(F.array(groups)).alias("_cap"))
    raw = {t: F.nullif(F.get("_cap", F.lit(i)), F.lit("")) for i, t in enumerate(CAPTURE_TARGETS)}
    date = F.try_to_date(raw["file_date"], "yyyyMMdd")
    out = out.withColumns({
        "_ok": F.coalesce(F.size("_cap") == len(CAPTURE_TARGETS), F.lit(False)),
        "_date": date,
        "_bad_date": raw["file_date"].isNotNull() & date.isNull(),
    })
    parsed = F.col("_ok") & ~F.col("_bad_date")
    typed = {}
    for t, kind in CAPTURE_TARGETS.items():
        value = F.col("_date") if kind == "date" else raw[t].try_cast("int") if kind == "int" else raw[t]
        typed[t] = F.when(parsed, value)
    out = out.withColumns(typed).withColumns({
        "parse_status": F.when(parsed, "PARSED").otherwise("PARSE_FAILED"),
        "parse_reason": F.when(~F.col("_ok"), REASON_NO_MATCH).when(F.col("_bad_date"), REASON_BAD_DATE),
    })
    out = out.withColumn("file_version_rank", version_rank(F.col("file_version_label")))
    return add_group_keys(out, file_name, feed_key).drop("_cap", "_ok", "_date", "_bad_date")


def add_group_keys(df: DataFrame, file_name: str = "file_name", feed_key: str = "feed_key") -> DataFrame:
    """Delivery and part keys by what the name carries: date and part, date only, or neither."""
    dated = F.concat_ws(
        "|", F.col(feed_key), F.coalesce(F.col("vendor_code"), F.lit("")),
        F.coalesce(F.col("lob_code"), F.lit("")), F.col("file_date").cast("string"),
    )
    has_date = F.col("file_date").isNotNull()
    delivery = F.when(has_date, dated).otherwise(F.col(feed_key))
    part = (
        F.when(has_date & F.col("file_part_seq").isNotNull(), F.concat_ws("|", dated, F.col("file_part_seq").cast("string")))
        .when(has_date, dated)
        .otherwise(F.concat_ws("|", F.col(feed_key), F.col(file_name)))
    )
    ok = F.col("parse_status") == "PARSED"
    return df.withColumns({"delivery_group_key": F.when(ok, delivery), "part_group_key": F.when(ok, part)})
