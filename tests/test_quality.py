"""Rules, tiers, thresholds, dependencies, quarantine."""
import pytest

from feedyard.operators import quality as q
from feedyard.operators.quality import Rule


def _rows(spark, values, file="fp"):
    return spark.createDataFrame([(file, i, v) for i, v in enumerate(values, 2)], "file_fingerprint string, src_row_number bigint, x string")


def _run(spark, rows, rules):
    masked = q.with_mask(rows, rules, "2026-01-15")
    state = q.decide(masked, rules)
    return masked, state, {r["rule_name"]: r for r in q.results(state, rules).collect()}


@pytest.mark.parametrize("bad,threshold,action,want", [
    (1, None, "WARN", "WARNED"), (0, None, "FAIL", "PASSED"), (10, 10.0, "FAIL", "PASSED"), (11, 10.0, "FAIL", "FAILED"),
    (11, 10.0, "DROP", "DROPPED"), (11, 10.0, "QUARANTINE", "QUARANTINED"), (3, 5.0, "WARN", "PASSED"),
])
def test_thresholds(spark, bad, threshold, action, want):
    rows = _rows(spark, [None] * bad + ["v"] * (100 - bad))
    _, _, got = _run(spark, rows, [Rule("r", 1, "x IS NOT NULL", action, threshold)])
    assert got["r"]["outcome"] == want and got["r"]["cnt_total"] == got["r"]["cnt_pass"] + got["r"]["cnt_fail"] == 100


def test_null_result_and_failed_cast_are_failures(spark):
    _, _, got = _run(spark, _rows(spark, ["1", "a", None]), [Rule("n", 1, "CAST(x AS INT) > 0"), Rule("d", 1, "cast(x AS DATE) <= current_date()")])
    assert got["n"]["cnt_fail"] == 2 and got["d"]["cnt_fail"] == 3


def test_dependency_chain_cycle_and_unknown(spark):
    rules = [Rule("c", 2, "true", depends_on=("a", "b")), Rule("b", 2, "true", depends_on=("a",)), Rule("a", 2, "x = 'z'", "DROP"),
             Rule("p", 1, "true", depends_on=("q",)), Rule("q", 1, "true", depends_on=("p",)), Rule("after_cycle", 1, "true", depends_on=("p",)),
             Rule("ghost", 1, "true", depends_on=("nobody",)), Rule("fine", 2, "true", depends_on=("warned",)), Rule("warned", 1, "x = 'z'", "WARN")]
    _, _, got = _run(spark, _rows(spark, ["v"]), rules)
    assert {n: r["outcome"] for n, r in got.items()} == {
        "a": "DROPPED", "b": "SKIPPED", "c": "SKIPPED", "p": "SKIPPED", "q": "SKIPPED", "after_cycle": "SKIPPED", "ghost": "SKIPPED", "fine": "PASSED", "warned": "WARNED"}
    assert got["c"]["skip_reason"] == "dependency a not met" and got["p"]["skip_reason"] == "circular dependency"


def test_drop_shrinks_the_next_tier_and_fail_aborts_per_file(spark):
    rules = [Rule("present", 1, "x IS NOT NULL", "DROP"), Rule("no_boom", 1, "coalesce(x, '') <> 'boom'", "FAIL"), Rule("short", 2, "length(x) < 3", "QUARANTINE", 10.0),
             Rule("soft", 3, "x <> 'a'", "WARN")]
    rows = _rows(spark, ["a", None, "b", "long"]).unionByName(_rows(spark, ["boom", None, "c"], "bad"))
    masked = q.with_mask(rows, rules)
    state = q.decide(masked, rules)
    got = {(r["file_fingerprint"], r["rule_name"]): r for r in q.results(state, rules).collect()}
    assert got[("fp", "short")]["cnt_total"] == 3 and got[("fp", "soft")]["cnt_total"] == 2 and got[("fp", "soft")]["outcome"] == "WARNED"
    assert ("bad", "short") not in got
    assert {r["file_fingerprint"]: r["dq_status"] for r in q.file_status(state, rules).collect()} == {"fp": "QUARANTINED", "bad": "FAILED"}
    disposed = q.dispose(masked, state, rules)
    words = {(r["file_fingerprint"], r["x"]): r["disposition"] for r in disposed.collect()}
    assert words == {("fp", "a"): "KEPT", ("fp", None): "DROPPED", ("fp", "b"): "KEPT", ("fp", "long"): "QUARANTINED",
                     ("bad", "boom"): "ABORTED", ("bad", None): "DROPPED", ("bad", "c"): "ABORTED"}
    assert sorted(r["x"] for r in q.kept(disposed, rules).collect()) == ["a", "b"]
    held = q.quarantined(disposed, rules).collect()
    assert [(r["x"], r["src_row_number"]) for r in held] == [("long", 5)]
    v = q.violations(disposed, rules).collect()
    assert [(r["rule_name"], r["columns_violated"], r["column_values"], r["quarantine_id"]) for r in v] == [("short", "x", "long", held[0]["quarantine_id"])]


def test_everything_dropped_leaves_an_empty_tier_that_passes(spark):
    rules = [Rule("present", 1, "x IS NOT NULL", "DROP"), Rule("next", 2, "x = 'never'", "FAIL")]
    _, _, got = _run(spark, _rows(spark, [None, None]), rules)
    assert (got["next"]["cnt_total"], got["next"]["pct_fail"], got["next"]["outcome"]) == (0, 0.0, "PASSED")


def test_values_are_cut_and_rules_loaded(spark):
    rules = [Rule("short", 1, "length(x) < 3 AND 'x' = 'x'", "QUARANTINE")]
    masked, state, _ = _run(spark, _rows(spark, ["y" * 500]), rules)
    assert len(q.violations(q.dispose(masked, state, rules), rules).first()["column_values"]) == 200
    table = spark.createDataFrame([("f", "a", 1, "b|c", "VALIDITY", "x", "warn", None, "Y"), ("f", "off", 1, None, "VALIDITY", "x", "WARN", None, "N"), ("g", "o", 1, None, "VALIDITY", "x", "WARN", 1.0, "Y")],
                                  "feed_key string, rule_name string, rule_tier int, depends_on string, rule_type string, rule_expression string, action_on_failure string, threshold_pct double, is_active string")
    assert q.active_rules(table, "f") == [Rule("a", 1, "x", "WARN", None, ("b", "c"), "VALIDITY")]
    assert q.active_rules(table, "none") == []
    assert q.row_flags(_rows(spark, ["abc"]), rules).first()["dq_rules_failed"] == ["short"]


def test_rules_that_all_depend_on_all_before_are_ordered_at_once():
    from feedyard.operators.quality import Rule, in_order
    names = [f"r{k:02d}" for k in range(60)]
    rules = [Rule(n, 1, "true", "WARN", None, tuple(names[:k])) for k, n in enumerate(names)]
    ordered, cyclic = in_order(rules[::-1])
    assert [r.name for r in ordered] == names and not cyclic
    loop = [Rule("a", 1, "true", "WARN", None, ("b",)), Rule("b", 1, "true", "WARN", None, ("a",)), Rule("c", 1, "true", "WARN", None, ("a",))]
    assert in_order(loop)[1] == {"a", "b"}


def test_quality_is_part_of_a_load(spark, tmp_path):
    from feedyard import schemas
    from feedyard.functions.fingerprints import enrich_listing
    from feedyard.operators import bronze, commits, inventory, logs
    from feedyard.plans import ingest
    from feedyard.sources.listing import list_files

    d = tmp_path / "drop"
    d.mkdir()
    (d / "a.txt").write_text("id|x\n1|ok\n2|\n3|odd\n4|ok\n")
    (d / "b.txt").write_text("id|x\nboom|ok\n2|ok\n")
    (d / "c.txt").write_text("id|x\n7|ok\n")
    (d / "z.zip").write_bytes(b"no archive")
    raw = [("f", "key", "1", "", "COMPLETENESS", "id <> 'boom'", "FAIL", "", ""), ("f", "full", "2", "", "COMPLETENESS", "x IS NOT NULL", "DROP", "", ""),
           ("f", "even", "3", "", "VALIDITY", "x <> 'odd'", "QUARANTINE", "", ""), ("f", "p", "3", "q", "VALIDITY", "true", "WARN", "", ""), ("f", "q", "3", "p", "VALIDITY", "true", "WARN", "", ""),
           ("f", "never", "1", "", "VALIDITY", "false", "FAIL", "", "N")]
    names = "feed_key string, rule_name string, rule_tier string, depends_on string, rule_type string, rule_expression string, action_on_failure string, threshold_pct string, is_active string"
    rules = q.read_rules(spark.createDataFrame(raw, names), "r.csv", "2026-01-15")
    feed = ingest.Feed("f", r"^(\w+)\.(txt|zip)$", "1|vendor_code|string;2|file_extension|string", recipients="ops")
    table, log = f"file:{tmp_path}/bronze", f"file:{tmp_path}/logs"
    refs = enrich_listing(list_files(spark, str(d)))

    def run(rules, batch, hour="12"):
        done = ingest.load(spark, feed, refs, table, log, batch, "r", "d", f"2026-01-15 {hour}:00:00", rules=rules)
        return {r["file_fingerprint"] for r in done.collect()}

    assert len(run(rules, "batch_001")) == 2
    run(rules, "batch_001")  # repeated: nothing is there twice
    assert sorted((r["id"], r["x"]) for r in bronze.read_bronze(spark, table).collect()) == [("1", "ok"), ("4", "ok"), ("7", "ok")]
    assert "src_row_number" not in bronze.read_bronze(spark, table).columns
    held = commits.committed(spark.read.parquet(f"{table}_quarantine"), commits.manifests(spark, table)).collect()
    assert [(r["id"], r["x"], r["src_row_number"], r["file_name"]) for r in held] == [("3", "odd", 4, "a.txt")]
    found = logs.read_log(spark, f"{log}/dq_violations", table).collect()
    assert [(r["rule_name"], r["columns_violated"], r["column_values"], r["quarantine_id"]) for r in found] == [("even", "x", "odd", held[0]["quarantine_id"])]
    results = logs.read_log(spark, f"{log}/dq_results", table)
    assert results.columns == schemas.names(schemas.DQ_RESULTS) and results.filter("file_name = 'b.txt'").count() == 1
    files = {r["file_name"]: r for r in commits.loaded_files(spark, table).collect()}
    assert {n: r["dq_status"] for n, r in files.items()} == {"a.txt": "QUARANTINED", "b.txt": "FAILED", "c.txt": "PASSED"}
    assert files["b.txt"]["status_reason"] == "data quality failed: key" and files["b.txt"]["load_status"] == "DISCOVERED"
    ended = logs.read_log(spark, f"{log}/file_log", table).filter("stage_name = 'INGEST_CONTROL' AND stage_status = 'FAILED'")
    assert {r["file_name"] for r in ended.collect()} == {"b.txt", "z.zip"}
    told = logs.read_log(spark, f"{log}/notifications", table).filter("event_type LIKE 'DQ%'").collect()
    assert sorted((r["severity"], r["event_type"], r["resolved_recipients"]) for r in told) == [
        ("ERROR", "DQ_DEPENDENCY_CYCLE", "ops"), ("ERROR", "DQ_FILE_FAILED", "ops"), ("WARNING", "DQ_ROWS_DROPPED", "ops"), ("WARNING", "DQ_ROWS_QUARANTINED", "ops")]
    state = inventory.adjudicate(inventory.with_loads(spark.createDataFrame([], schemas.INVENTORY), commits.loaded_files(spark, table)))
    assert {r["file_name"]: r["promote_status"] for r in state.collect()} == {"a.txt": "NOT_READY", "b.txt": "NOT_READY", "c.txt": "READY_FOR_SILVER"}
    # a feed without rules is not evaluated, and all its rows are loaded
    assert len(run(rules.filter("feed_key = 'other'"), "batch_002", "14")) == 3
    assert {r["dq_status"] for r in commits.loaded_files(spark, table).collect()} == {"NOT_EVALUATED"}
    assert bronze.read_bronze(spark, table).count() == 3 + 7
