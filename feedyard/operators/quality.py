"""Tiered data-quality rules.

One scan evaluates all rules and reduces the rows to counts per file and failure pattern. Tiers,
thresholds and dependencies are then decided on that small table; a second scan applies the
outcome. The number of tiers does not add scans.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from feedyard.functions.text import col_q
from feedyard.operators.skew import lookup_join
from feedyard.session import stable

# Actions with their outcome, and the notification each outcome raises.
OUTCOMES = {"WARN": "WARNED", "DROP": "DROPPED", "FAIL": "FAILED", "QUARANTINE": "QUARANTINED"}
SATISFIED = ("PASSED", "WARNED")
NOTIFY = {
    "WARNED": ("WARNING", "DQ_THRESHOLD_BREACHED"), "DROPPED": ("WARNING", "DQ_ROWS_DROPPED"),
    "FAILED": ("ERROR", "DQ_FILE_FAILED"), "QUARANTINED": ("WARNING", "DQ_ROWS_QUARANTINED"),
}
VALUE_LENGTH = 200
FILE = ["file_fingerprint"]


@dataclass(frozen=True)
class Rule:
    name: str
    tier: int
    expression: str
    action: str = "WARN"
    threshold: float | None = None
    depends_on: tuple[str, ...] = ()
    kind: str = "VALIDITY"


def active_rules(rules: DataFrame, feed_key: str) -> list[Rule]:
    """The rules of one feed. A feed's rules are configuration, tens of rows, and shape the plan."""
    rows = rules.filter((F.col("feed_key") == feed_key) & (F.upper("is_active") == "Y")).collect()
    return [
        Rule(r["rule_name"], int(r["rule_tier"]), r["rule_expression"], r["action_on_failure"].strip().upper(), r["threshold_pct"],
             tuple(d.strip() for d in (r["depends_on"] or "").split("|") if d.strip()), r["rule_type"])
        for r in rows
    ]


def read_rules(raw: DataFrame, source_file: str, now) -> DataFrame:
    """Rule table content from CSV text columns; it replaces the table as a whole."""
    def text(c: str) -> Column:
        return F.nullif(F.trim(F.col(c)), F.lit(""))

    return raw.filter(text("rule_name").isNotNull()).select(
        text("feed_key").alias("feed_key"), text("rule_name").alias("rule_name"), text("rule_tier").try_cast("int").alias("rule_tier"),
        text("depends_on").alias("depends_on"), F.upper(text("rule_type")).alias("rule_type"), text("rule_expression").alias("rule_expression"),
        F.upper(text("action_on_failure")).alias("action_on_failure"), text("threshold_pct").try_cast("double").alias("threshold_pct"),
        F.upper(F.coalesce(text("is_active"), F.lit("Y"))).alias("is_active"), F.lit(source_file).alias("config_source_file"),
        F.lit(now).cast("timestamp").alias("ts_synced"))


def in_order(rules: list[Rule]) -> tuple[list[Rule], set[str]]:
    """Rules by tier and dependency depth, and the names of those caught in a cycle."""
    by_name = {r.name: r for r in rules}

    needs = {r.name: [d for d in r.depends_on if d in by_name and by_name[d].tier == r.tier] for r in rules}
    # a rule has a depth once all it needs have one; what waits for a cycle never gets one
    depths: dict[str, int] = {}
    ready = [n for n, ds in needs.items() if not ds]
    while ready:
        depths |= {n: 1 + max((depths[d] for d in needs[n]), default=-1) for n in ready}
        ready = [n for n, ds in needs.items() if n not in depths and all(d in depths for d in ds)]

    # only members of a cycle count as cyclic; what merely depends on one is skipped by its dependency
    def reaches(start: str) -> bool:
        todo, seen = list(by_name[start].depends_on), set()
        while todo:
            n = todo.pop()
            if n == start:
                return True
            if n in by_name and n not in seen:
                seen.add(n)
                todo += by_name[n].depends_on
        return False

    cyclic = {n for n in needs if n not in depths and reaches(n)}
    return sorted(rules, key=lambda r: (r.tier, depths.get(r.name, len(rules)), r.name)), cyclic


def passes(rule: Rule, today: str | None = None) -> Column:
    """Whether a row satisfies a rule. NULL is a failure, and a cast that fails is NULL."""
    text = re.sub(r"\bCAST\s*\(", "TRY_CAST(", rule.expression, flags=re.IGNORECASE)
    if today:
        text = re.sub(r"\bcurrent_date\s*(\(\s*\))?", f"DATE'{today}'", text, flags=re.IGNORECASE)
    return F.coalesce(F.expr(text), F.lit(False))


def with_mask(rows: DataFrame, rules: list[Rule], today: str | None = None) -> DataFrame:
    """Add ``_mask``: one character per rule, 1 where the row fails it."""
    return rows.withColumn("_mask", F.concat(*[F.when(passes(r, today), "0").otherwise("1") for r in rules]))


def failed(position: int) -> Column:
    return F.substr("_mask", F.lit(position + 1), F.lit(1)) == "1"


def row_flags(rows: DataFrame, rules: list[Rule], today: str | None = None) -> DataFrame:
    """Per row a status and the names of the rules it fails."""
    names = F.array_compact(F.array(*[F.when(~passes(r, today), F.lit(r.name)) for r in rules]))
    return rows.withColumn("dq_rules_failed", names).withColumn("dq_status", F.when(F.size("dq_rules_failed") == 0, "PASSED").otherwise("FAILED"))


def rule_metrics(rows: DataFrame, rules: list[Rule], today: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Total, passed and failed rows per rule, in one pass."""
    by = by or []
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(passes(r, today)).alias(f"_p{i}") for i, r in enumerate(rules)])
    lines = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule_name"), F.col(f"_p{i}").alias("cnt_pass")) for i, r in enumerate(rules)]))
    return counts.select(*by, "_n", lines.alias("m")).select(
        *by, "m.rule_name", F.col("_n").alias("cnt_total"), "m.cnt_pass", (F.col("_n") - F.col("m.cnt_pass")).alias("cnt_fail"),
        F.when(F.col("_n") > 0, 100.0 * (F.col("_n") - F.col("m.cnt_pass")) / F.col("_n")).otherwise(0.0).alias("pct_fail"))


def decide(masked: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per file with every rule's counts and outcome, and whether the file is aborted.

    ``rules`` must be in the order the mask was built in. An empty tier passes, since no row fails.
    """
    ordered, cyclic = in_order(rules)
    position = {r.name: i for i, r in enumerate(rules)}
    patterns = stable(masked.groupBy(*FILE, "_mask").agg(F.count(F.lit(1)).alias("_n")))
    state = patterns.groupBy(*FILE).agg(F.sum("_n").alias("_rows")).withColumn("_aborted", F.lit(False))
    alive = patterns
    for tier in sorted({r.tier for r in rules}):
        members = [r for r in ordered if r.tier == tier]
        sums = [F.sum(F.when(failed(position[r.name]), F.col("_n")).otherwise(0)).alias(f"_f{position[r.name]}") for r in members]
        metrics = alive.groupBy(*FILE).agg(F.sum("_n").alias(f"_t{tier}"), *sums)
        state = state.join(metrics, FILE, "left")
        state = state.withColumns({c: F.coalesce(c, F.lit(0)) for c in metrics.columns if c not in FILE})
        for r in members:
            i, known = position[r.name], {x.name for x in ordered[: ordered.index(r)]}
            pct = F.when(F.col(f"_t{tier}") > 0, 100.0 * F.col(f"_f{i}") / F.col(f"_t{tier}")).otherwise(0.0)
            skip = F.lit(None).cast("string")
            if r.name in cyclic:
                skip = F.lit("circular dependency")
            else:
                for d in reversed(r.depends_on):
                    if d not in known:
                        skip = F.lit(f"dependency {d} not evaluated")
                    else:
                        skip = F.when(~F.col(f"_o{position[d]}").isin(*SATISFIED), F.lit(f"dependency {d} not met")).otherwise(skip)
            state = state.withColumns({f"_p{i}": pct, f"_s{i}": skip})
            outcome = (F.when(F.col("_aborted"), F.lit(None)).when(F.col(f"_s{i}").isNotNull(), "SKIPPED")
                       .when(F.col(f"_p{i}") <= F.lit(float(r.threshold or 0.0)), "PASSED").otherwise(OUTCOMES[r.action]))
            state = state.withColumn(f"_o{i}", outcome)
        fails = [F.coalesce(F.col(f"_o{position[r.name]}") == "FAILED", F.lit(False)) for r in members]
        state = state.withColumn("_aborted", F.col("_aborted") | F.greatest(*fails, F.lit(False)))
        removing = [r for r in members if r.action in ("DROP", "QUARANTINE")]
        if tier < max(r.tier for r in rules):
            verdict = state.select(*FILE, "_aborted", *[f"_o{position[r.name]}" for r in removing])
            gone = F.lit(False)
            for r in removing:
                gone = gone | (F.col(f"_o{position[r.name]}").isin("DROPPED", "QUARANTINED") & failed(position[r.name]))
            alive = alive.select(*FILE, "_mask", "_n").join(verdict, FILE).filter(~F.col("_aborted") & ~F.coalesce(gone, F.lit(False)))
    return stable(state)


def results(state: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per file and evaluated rule; rules of tiers after an abort have none."""
    lines = []
    for i, r in enumerate(rules):
        ran = F.col(f"_o{i}") != "SKIPPED"
        total, bad = F.when(ran, F.col(f"_t{r.tier}")).otherwise(0), F.when(ran, F.col(f"_f{i}")).otherwise(0)
        lines.append(F.struct(
            F.lit(r.name).alias("rule_name"), F.lit(r.tier).alias("rule_tier"), F.lit(r.kind).alias("rule_type"), F.lit(r.expression).alias("rule_expression"),
            F.lit(r.action).alias("action_on_failure"), total.alias("cnt_total"), (total - bad).alias("cnt_pass"), bad.alias("cnt_fail"),
            F.when(ran, F.col(f"_p{i}")).otherwise(0.0).alias("pct_fail"), F.lit(r.threshold).cast("double").alias("threshold_pct"),
            F.when(ran & (F.col(f"_o{i}") != "PASSED"), "Y").otherwise("N").alias("threshold_breached"),
            F.col(f"_o{i}").alias("outcome"), F.col(f"_s{i}").alias("skip_reason")))
    return state.select(*FILE, F.explode(F.array(*lines)).alias("r")).select(*FILE, "r.*").filter(F.col("outcome").isNotNull())


def file_status(state: DataFrame, rules: list[Rule]) -> DataFrame:
    """``dq_status`` per file: failed, else quarantined, else warned (also when rows were dropped), else passed."""
    seen = F.array(*[F.coalesce(F.col(f"_o{i}"), F.lit("")) for i in range(len(rules))])
    status = (F.when(F.col("_aborted"), "FAILED").when(F.array_contains(seen, "QUARANTINED"), "QUARANTINED")
              .when(F.array_contains(seen, "WARNED") | F.array_contains(seen, "DROPPED"), "WARNED").otherwise("PASSED"))
    return state.select(*FILE, status.alias("dq_status"))


def dispose(masked: DataFrame, state: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``disposition`` (KEPT, DROPPED, QUARANTINED, ABORTED) and the tier that removed the row.

    Files join their outcome by fingerprint; a file of very many rows takes the spread branch.
    """
    outcomes = [f"_o{i}" for i in range(len(rules))]
    rows = lookup_join(masked, state.select(*FILE, "_rows", "_aborted", *outcomes), FILE, "_rows", spread_by=F.xxhash64("_mask", *[
        col_q(c) for c in masked.columns if c not in (*FILE, "_mask")]))
    where = F.lit(None).cast("string")
    for tier in sorted({r.tier for r in rules}, reverse=True):
        for action, word in (("QUARANTINE", "QUARANTINED"), ("DROP", "DROPPED")):
            for i, r in enumerate(rules):
                if r.tier == tier and r.action == action:
                    where = F.when((F.col(f"_o{i}") == word) & failed(i), F.lit(f"{word}:{tier}")).otherwise(where)
    out = rows.withColumn("_gone", where)
    word = F.coalesce(F.split_part("_gone", F.lit(":"), F.lit(1)), F.when(F.col("_aborted"), "ABORTED").otherwise("KEPT"))
    return out.withColumns({"disposition": word, "removed_tier": F.split_part("_gone", F.lit(":"), F.lit(2)).try_cast("int")}).drop("_gone")


def _bare(disposed: DataFrame, rules: list[Rule]) -> list[str]:
    own = {"_mask", "_aborted", "disposition", "removed_tier", *[f"_o{i}" for i in range(len(rules))]}
    return [c for c in disposed.columns if c not in own]


def kept(disposed: DataFrame, rules: list[Rule]) -> DataFrame:
    return disposed.filter("disposition = 'KEPT'").select(*[col_q(c) for c in _bare(disposed, rules)])


def quarantine_id(row_number: str = "src_row_number") -> Column:
    return F.sha2(F.concat_ws("|", "file_fingerprint", F.col(row_number).cast("string")), 256)


def quarantined(disposed: DataFrame, rules: list[Rule]) -> DataFrame:
    """Quarantined rows as they were, with their id."""
    return disposed.filter("disposition = 'QUARANTINED'").select(quarantine_id().alias("quarantine_id"), *[col_q(c) for c in _bare(disposed, rules)])


def columns_of(rule: Rule, columns: list[str]) -> list[str]:
    """Columns a rule's text names."""
    bare = re.sub(r"'[^']*'", "''", rule.expression)
    return [c for c in columns if re.search(rf"(?<!\w){re.escape(c)}(?!\w)", bare, flags=re.IGNORECASE)]


def violations(disposed: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule a quarantined row fails, up to the tier that removed it, with the values it failed on."""
    business = _bare(disposed, rules)
    lines = []
    for i, r in enumerate(rules):
        used = columns_of(r, business)
        values = F.concat_ws("|", *[F.left(F.coalesce(col_q(c).cast("string"), F.lit("")), F.lit(VALUE_LENGTH)) for c in used]) if used else F.lit(None).cast("string")
        counts = failed(i) & (F.lit(r.tier) <= F.col("removed_tier")) & (F.col(f"_o{i}") != "SKIPPED")
        lines.append(F.when(counts, F.struct(
            F.lit(r.name).alias("rule_name"), F.lit(r.tier).alias("rule_tier"), F.lit(r.kind).alias("rule_type"), F.lit(r.expression).alias("rule_expression"),
            F.lit("|".join(used) or None).cast("string").alias("columns_violated"), values.alias("column_values"))))
    hit = disposed.filter("disposition = 'QUARANTINED'").withColumn("_v", F.explode(F.array_compact(F.array(*lines))))
    return hit.select(
        F.sha2(F.concat_ws("|", quarantine_id(), F.col("_v.rule_name")), 256).alias("violation_id"), quarantine_id().alias("quarantine_id"),
        "file_fingerprint", "src_row_number", "_v.*")


def top_rules(violated: DataFrame) -> DataFrame:
    return violated.groupBy("rule_name", "feed_key").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "rule_name", "feed_key")


def dq_notifications(result: DataFrame) -> DataFrame:
    """Severity and event of every outcome that someone should hear of."""
    kinds = F.create_map(*[x for o, (s, e) in NOTIFY.items() for x in (F.lit(o), F.struct(F.lit(s).alias("severity"), F.lit(e).alias("event_type")))])
    told = result.withColumn("_k", F.try_element_at(kinds, F.col("outcome")))
    return told.filter(F.col("_k").isNotNull()).select(
        *FILE, "rule_name", "outcome", "_k.severity", F.lit("INGESTION").alias("category"), "_k.event_type",
        F.format_string("Rule %s %s: %d of %d rows failed", "rule_name", F.lower("outcome"), "cnt_fail", "cnt_total").alias("message"))
