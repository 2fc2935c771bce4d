"""Adjudication cases, merges, configuration and drift."""
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feedyard import schemas
from feedyard.functions.fingerprints import packed, unpacked
from feedyard.operators import config_sync, drift, inventory, skew, upsert as ups
from feedyard.operators.upsert import delete_where, src, update_where, upsert


def _inventory(spark, rows):
    names = ("file_name", "part_group_key", "delivery_group_key", "file_part_seq", "file_part_tot", "file_version_rank", "parse_status", "load_status", "cnt_row_bronze", "ts_discovered")
    kinds = dict(schemas.fields(schemas.INVENTORY))
    ddl = ", ".join(f"{n} {'string' if n == 'ts_discovered' else kinds[n]}" for n in names)
    df = spark.createDataFrame(rows, ddl).withColumns({"file_fingerprint": F.concat(F.lit("fp_"), "file_name"), "feed_key": F.lit("f")})
    return df.select([F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in schemas.fields(schemas.INVENTORY)])


def _part(name, seq, tot, rank=0, load="LOADED_BRONZE", rows=5, delivery="d", ts="2026-01-01"):
    return (name, f"{delivery}|{seq}", delivery, seq, tot, rank, "PARSED", load, rows, ts)


CASES = {
    "newer version wins": ([_part("a", 1, 2), _part("a2", 1, 2, 2), _part("b", 2, 2)],
                           {"a": "superseded by newer version", "a2": "latest and ready for silver", "b": "latest and ready for silver"}),
    "incomplete": ([_part(f"p{i}", i, 5) for i in (1, 2, 3)], {f"p{i}": "latest but delivery incomplete" for i in (1, 2, 3)}),
    "one not loaded": ([_part("a", 1, 2), _part("b", 2, 2, load="DISCOVERED", rows=None)], {"a": "latest but some parts not bronze loaded", "b": "latest but bronze not loaded"}),
    "zero rows": ([_part("a", 1, 1, rows=0)], {"a": "latest but zero rows loaded"}),
    "same rank, later discovery": ([_part("a", 1, 1), _part("z", 1, 1, ts="2025-12-31")], {"a": "latest and ready for silver", "z": "superseded by newer version"}),
    "no discovery time is oldest": ([_part("a", 1, 1, ts=None), _part("b", 1, 1)], {"a": "superseded by newer version", "b": "latest and ready for silver"}),
    "bare and dated need no parts": ([("x", "f|x", "f", None, None, 0, "PARSED", "LOADED_BRONZE", 3, None), ("y", "f|y", "f", None, None, 0, "PARSED", "DISCOVERED", None, None)],
                                     {"x": "latest and ready for silver", "y": "latest but bronze not loaded"}),
    "superseded version still counts for the expected total": ([_part("a", 1, 3), _part("a2", 1, 1, 1)], {"a": "superseded by newer version", "a2": "latest but delivery incomplete"}),
    "parse failed": ([("n", None, None, None, None, 0, "PARSE_FAILED", "PARSE_FAILED", None, None)], {"n": "filename parse failed"}),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("hot_rows", [10 ** 6, 0])
def test_adjudication(spark, name, hot_rows):
    rows, want = CASES[name]
    got = {r["file_name"]: r for r in inventory.adjudicate(_inventory(spark, rows), hot_rows).collect()}
    assert {n: r["status_reason"] for n, r in got.items()} == want
    for r in got.values():
        ready = r["status_reason"] == inventory.REASON_READY
        assert (r["promote_status"] == "READY_FOR_SILVER") is ready and (r["flg_legit_for_silver"] == "Y") is ready
        assert (r["flg_superseded"] == "Y") is ("superseded" in r["status_reason"])


def test_discovery_keeps_state_and_is_idempotent(spark):
    known = _inventory(spark, [_part("a", 1, 1)])
    again = _inventory(spark, [_part("a", 1, 1, load="DISCOVERED", rows=None, ts="2026-02-02"), _part("b", 2, 2, load="DISCOVERED", rows=None)])
    once = inventory.merge_inventory(known, again)
    rows = {r["file_name"]: r for r in once.collect()}
    assert rows["a"]["load_status"] == "LOADED_BRONZE" and rows["a"]["cnt_row_bronze"] == 5 and str(rows["a"]["ts_discovered"]).startswith("2026-02-02")
    assert rows["b"]["load_status"] == "DISCOVERED"
    twice = inventory.merge_inventory(once, again)
    assert twice.exceptAll(once).count() == 0 and twice.count() == once.count() == 2


BIGINT = st.integers(-2 ** 63, 2 ** 63 - 1)  # what the column can hold


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 12), BIGINT, max_size=8), st.dictionaries(st.integers(0, 12), BIGINT, max_size=8))
def test_upsert_is_a_dict_update(spark, old, new):
    def df(d):
        return spark.createDataFrame(list(d.items()), "k int, v bigint") if d else spark.createDataFrame([], "k int, v bigint")
    out = upsert(df(old), df(new), ["k"], [(F.lit(True), {"v": src("v")})])
    assert {r["k"]: r["v"] for r in out.collect()} == {**old, **new}


def test_upsert_clauses_duplicates_update_delete(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (2, "y"), (9, "z")], "k int, v string")
    out = upsert(t, s, ["k"], [(src("v") == "x", {"v": F.lit("first")}), (F.lit(True), {"v": F.concat("v", src("v"))})], insert=False)
    assert sorted(map(tuple, out.collect())) == [(1, "first"), (2, "by"), (3, "c")]
    with pytest.raises(Exception, match="several source rows"):
        upsert(t, s.union(s), ["k"], [(F.lit(True), {"v": src("v")})]).collect()
    assert sorted(map(tuple, update_where(t, F.col("k") > 1, {"v": F.lit("n")}).collect())) == [(1, "a"), (2, "n"), (3, "n")]
    assert sorted(map(tuple, delete_where(t, F.lit(None).cast("boolean")).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def _config(spark, rows):
    df = spark.createDataFrame(rows, "feed_key string, feed_sub_key string, tgt_bronze_table string, config_source_file string, mtime int, row_no int")
    return df.withColumn("config_source_mtime", F.timestamp_seconds("mtime"))


@pytest.mark.parametrize("rows,winner,dropped", [
    ([("f", "", "old", "z.csv", 1, 0), ("f", "DEFAULT", "new", "a.csv", 2, 0)], "new", [("z.csv", "a.csv", "superseded by newer file a.csv")]),
    ([("f", "", "one", "a.csv", 1, 0), (" f ", "", "two", "a.csv", 1, 1)], "one", [("a.csv", "a.csv", "duplicate in same file; earlier row kept")]),
    ([("f", "", "one", "a.csv", 1, 0), ("f", "", "two", "b.csv", 1, 0)], "one", [("b.csv", "a.csv", "duplicate in older file; earlier row kept")]),
    ([("f", "", "1", "a.csv", 1, 0), ("f", "", "2", "b.csv", 2, 0), ("f", "", "3", "c.csv", 3, 0)], "3",
     [("a.csv", "b.csv", "superseded by newer file b.csv"), ("b.csv", "c.csv", "superseded by newer file c.csv")]),
])
def test_config_deduplication(spark, rows, winner, dropped):
    df = _config(spark, rows)
    kept = config_sync.deduplicate(df).collect()
    assert [(r["feed_key"], r["feed_sub_key"], r["tgt_bronze_table"]) for r in kept] == [("f", "DEFAULT", winner)]
    assert sorted((r["dropped_from"], r["winner_from"], r["reason"]) for r in config_sync.dropped(df).collect()) == sorted(dropped)


def test_config_defaults_and_normalization(spark):
    raw = spark.createDataFrame([("f", " ", "t", "7"), ("", "x", "t", "")], "feed_key string, ctl_active string, tgt_bronze_table string, batch_max_files string")
    rows = config_sync.fill_defaults(raw).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["feed_sub_key"], r["ctl_active"], r["src_file_delimiter"], r["batch_max_files"], r["batch_max_size_gb"], r["sched_lookback_minutes"]) == ("DEFAULT", "Y", "|", 7, 1.0, 1440)
    assert r["tgt_silver_table"] == r["tgt_gold_table"] == r["tgt_volume"] == "t" and r["sched_timezone"] == "UTC"
    odd = config_sync.fill_defaults(raw).withColumns({"ctl_demo_seed_policy": F.lit("nope"), "schema_read_policy": F.lit(" seed "), "batch_max_files": F.lit(0), "notify_recipients": F.lit("ops")})
    n = config_sync.normalize(odd).first()
    assert (n["ctl_demo_seed_policy"], n["schema_read_policy"], n["batch_max_files"], n["notify_recipients"]) == ("AUTO", "SEED", 10, "ops")


def test_seed_refresh_and_environment_policy(spark):
    df = spark.createDataFrame([("COPY",), ("skip",), ("AUTO",), (None,)], "p string")
    assert [r[0] for r in df.select(config_sync.refresh_seed(F.col("p"), True, F.lit(True))).collect()] == [True, False, True, True]
    assert [r[0] for r in df.select(config_sync.refresh_seed(F.col("p"), True, F.lit(False))).collect()] == [True, False, False, False]
    cfg = spark.createDataFrame([("a", "D", " "), ("b", "D", "s3://x")], "feed_key string, feed_sub_key string, src_uri string")
    assert [r["feed_key"] for r in config_sync.policy_violations(cfg, "prod", True).collect()] == ["a"]
    assert config_sync.policy_violations(cfg, "dev", False).count() == 0


@pytest.mark.parametrize("source,target,header,want", [
    (["a", "b"], ["a", "b"], True, ("N", "source columns match target schema")), (["a", "c"], ["a", "b"], True, ("Y", "missing_in_file=b; new_in_file=c")),
    (["a"], ["a", "b"], True, ("Y", "missing_in_file=b")), (["A"], ["a"], True, ("Y", "missing_in_file=a; new_in_file=A")),
    (["x", "x"], [], True, ("Y", "new_in_file=x,x")), (["a"], ["b"], False, ("N", "header disabled; schema comparison skipped")),
])
def test_drift(spark, source, target, header, want):
    df = spark.createDataFrame([(source, target)], "source_columns array<string>, target_columns array<string>")
    r = drift.detect_drift(df, has_header=header).first()
    assert (r["change_detected"], r["status_reason"]) == want


def test_schema_growth_and_policy(spark):
    df = spark.createDataFrame([(1,)], "Id int")
    out = drift.evolve_business(df, ["id", "", "d.e", "D.E", "x y"])
    assert out.columns == ["Id", "d.e", "x y"] and out.first()["d.e"] is None
    assert drift.initial_columns("FIRST_FILE", ["a"]) == [] and drift.initial_columns("AUTO", None) == [] and drift.initial_columns("SEED", ["a"]) == ["a"]
    with pytest.raises(FileNotFoundError):
        drift.initial_columns("SEED", None)


def test_large_sources_meet_the_target_in_one_join(spark, monkeypatch):
    """A source above the broadcast bound gives the same snapshot; unknown and equal-looking keys stay apart."""
    digest = "0" * 63 + "a"
    target = spark.createDataFrame([(digest, "a", 1), (None, "b", 2), ("fp", "c", 3), (digest.upper(), "d", 4), ("fp", "e", 5)], "k string, v string, n int")
    source = spark.createDataFrame([(digest, 10), (None, 20), ("new", 30), ("fp", 40)], "k string, n int")
    clauses = [(ups.src("n") > 30, {"v": F.lit("big"), "n": ups.src("n")}), (F.lit(True), {"n": ups.src("n")})]
    small = [[sorted(map(repr, ups.upsert(target, source, ["k"], clauses, insert).collect())) for insert in (True, False)]]
    monkeypatch.setattr(ups, "BROADCAST_ROWS", 0)
    large = [[sorted(map(repr, ups.upsert(target, source, ["k"], clauses, insert).collect())) for insert in (True, False)]]
    assert small == large
    plan = ups.upsert(target, source, ["k"], clauses)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and "LeftAnti" not in plan
    with pytest.raises(Exception, match="several source rows"):
        ups.upsert(target, source.union(source), ["k"], clauses).select("v").collect()


def test_fingerprints_travel_packed_and_come_back(spark):
    texts = ["0f" * 32, "0F" * 32, "0f" * 31, "x" * 31, "", None, "ab" * 31 + "a\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed(F.col("t")))
    got = rows.select("t", unpacked(F.col("p")).alias("back"), "p").collect()
    assert all(r["t"] == r["back"] for r in got) and len({bytes(r["p"]) for r in got}) == len(texts)
    assert len(next(bytes(r["p"]) for r in got if r["t"] == texts[0])) == 33


def test_tied_versions_end_with_the_highest_fingerprint_of_any_kind(spark):
    for prints in (["0f" * 32, "fp_1"], ["ff" * 32, "fp_1"], ["ff" * 32, "fe" * 32], ["zz", "fp_1"], ["ff" * 32, None]):
        rows = spark.createDataFrame([("p", "PARSED", 1, None, "same", f, "d", 1, 1, "LOADED_BRONZE", 5) for f in prints],
            "part_group_key string, parse_status string, file_version_rank int, ts_discovered timestamp, file_name string, file_fingerprint string, "
            "delivery_group_key string, file_part_seq int, file_part_tot int, load_status string, cnt_row_bronze bigint")
        won = inventory.part_winners(rows).collect()
        assert [r["file_fingerprint"] for r in won] == [max(f for f in prints if f)] and won[0]["versions"] == 2


def test_hot_keys_are_broadcast_up_to_a_bound(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 5 + ["b"] * 4 + ["c"] * 3 + ["d"] * 2 + ["e", None])], "k string, i int")
    lookup = spark.createDataFrame([("a", 5, "va"), ("b", 4, "vb"), ("c", 3, "vc"), ("d", 2, "vd"), (None, 9, "vn")], "k string, n bigint, v string")
    out = skew.lookup_join(facts, lookup, ["k"], "n", hot_rows=1)
    assert sorted((r["i"], r["v"]) for r in out.collect()) == [
        (i, f"v{k}" if k and k != "e" else None) for i, k in enumerate(["a"] * 5 + ["b"] * 4 + ["c"] * 3 + ["d"] * 2 + ["e", None])]
    assert "TakeOrderedAndProject(limit=2" in out._jdf.queryExecution().executedPlan().toString()
