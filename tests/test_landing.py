"""Filenames, requests, selection, classification and packing."""
import hashlib
import json
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feedyard.checks import views
from feedyard.functions import filenames
from feedyard.functions.filenames import check_regex, name_pattern, name_template, parse_by_rules, parse_filename, version_rank
from feedyard.functions.fingerprints import file_fingerprint
from feedyard.functions.requests import parse_request, truthy
from feedyard.operators import batching, selectors, skew, waterfall
from feedyard.session import kept

# A harbour's papers: the day comes first, then quay and ship, sheet and sheets joined by "of", and a revision after a tilde.
SHEETS = (r"^(\d{8})-(quay\d+)\.(\w+)-sheet(\d+)of(\d+)(?:~(v\d+|updated))?\.(csv|zip)$",
          "1|file_date|date_yyyymmdd;2|lob_code|string;3|vendor_code|string;4|file_part_seq|int;5|file_part_tot|int;6|file_version_label|string;7|file_extension|string")
TIDES = (r"^(\d{8})\.tides\.(txt)$", "1|file_date|date_yyyymmdd;2|file_extension|string")
BERTHS = (r"^(\d{8})(?:~(v\d+))?\.berths\.(txt)$", "1|file_date|date_yyyymmdd;2|file_version_label|string;3|file_extension|string")
LOGBOOK = (r"^(?P<ship>\w+)=logbook\.(csv)$", "1|vendor_code|string;2|file_extension|string")

# Feed, naming, file name, then status, rank, delivery and part key.
NAMES = [
    ("cargo", SHEETS, "20240229-quay7.Heron-sheet3of4.csv", "PARSED", 0, "cargo|Heron|quay7|2024-02-29", "cargo|Heron|quay7|2024-02-29|3"),
    ("cargo", SHEETS, "20240229-quay7.Heron-sheet3of4~v11.zip", "PARSED", 11, "cargo|Heron|quay7|2024-02-29", "cargo|Heron|quay7|2024-02-29|3"),
    ("cargo", SHEETS, "20240229-QUAY7.heron-Sheet4of4~Updated.CSV", "PARSED", 1, "cargo|heron|QUAY7|2024-02-29", "cargo|heron|QUAY7|2024-02-29|4"),
    ("cargo", SHEETS, "20240229-quay7.Heron-sheet.csv", "PARSE_FAILED", 0, None, None),
    ("tides", TIDES, "20231104.tides.txt", "PARSED", 0, "tides|||2023-11-04", "tides|||2023-11-04"),
    ("tides", TIDES, "20230230.tides.txt", "PARSE_FAILED", 0, None, None),
    ("tides", TIDES, "20231104.tides.txt.part", "PARSE_FAILED", 0, None, None),
    ("berths", BERTHS, "20231104~v6.berths.txt", "PARSED", 6, "berths|||2023-11-04", "berths|||2023-11-04"),
    ("logbook", LOGBOOK, "Plover=logbook.csv", "PARSED", 0, "logbook", "logbook|Plover=logbook.csv"),
]


def test_names_of_one_feed_and_of_many(spark):
    got = {}
    for feed, (regex, spec), name, *_ in NAMES:
        df = spark.createDataFrame([(feed, name)], "feed_key string, file_name string")
        r = parse_filename(df, regex, spec).first()
        got[name] = (r["parse_status"], r["file_version_rank"], r["delivery_group_key"], r["part_group_key"])
    assert got == {n[2]: tuple(n[3:]) for n in NAMES}
    rows = spark.createDataFrame([(f, n, rx, sp) for f, (rx, sp), n, *_ in NAMES], "feed_key string, file_name string, regex string, spec string")
    many = parse_by_rules(rows.withColumns({"name_pattern": name_pattern(F.col("regex")), "name_template": name_template(F.col("spec"))}))
    assert {r["file_name"]: (r["parse_status"], r["file_version_rank"], r["delivery_group_key"], r["part_group_key"]) for r in many.collect()} == got


def test_parse_reasons_and_types(spark):
    df = spark.createDataFrame([("f", n) for n in ("20230230.tides.txt", "nope", "20231104.tides.txt")], "feed_key string, file_name string")
    rows = {r["file_name"]: r for r in parse_filename(df, *TIDES).collect()}
    assert rows["20230230.tides.txt"]["parse_reason"] == "invalid file_date"
    assert rows["nope"]["parse_reason"] == "filename does not match configured regex"
    assert str(rows["20231104.tides.txt"]["file_date"]) == "2023-11-04"
    with pytest.raises(ValueError):
        check_regex(r"(?P<a>x)(?P=a)")


def test_version_rank(spark):
    labels = [(None, 0), ("", 0), ("Updated", 1), ("v2", 2), (" V12 ", 12), ("vx", 0), ("final", 0), ("v", 0)]
    df = spark.createDataFrame([(l,) for l, _ in labels], "label string")
    assert [r[0] for r in df.select(version_rank(F.col("label"))).collect()] == [n for _, n in labels]


def test_fingerprint_is_stable_over_path_forms(spark):
    df = spark.createDataFrame([("/Volumes/a/b.txt",), ("dbfs:/Volumes/a/b.txt/",), (" dbfs:/Volumes/a/b.txt ",)], "p string")
    prints = {r[0] for r in df.select(file_fingerprint(F.col("p"), F.lit(10), F.lit(None))).collect()}
    import hashlib
    assert prints == {hashlib.sha256(b"dbfs:/Volumes/a/b.txt|10|none").hexdigest()}


def test_requests(spark):
    texts = ["", '{"request_type":"BACKFILL","selector_type":"FILE_DATE","file_date_from":"2026-01-01","file_date_to":"2026-05-31"}',
             '{"request_type":"BACKFILL"}', '{"request_type":"adhoc","file_path":"x.txt"}', '{"request_type":"ADHOC","file_paths":["a","b"],"force_reprocess":true}',
             '{"force_reprocess":"no"}', '{"request_type":"REPLAY"}', "[1]", "not json", '{"request_type":"BACKFILL","selector_type":"FILE_MODIFIED_TS"}']
    rows = {r["request_json"]: r for r in parse_request(spark.createDataFrame([(t,) for t in texts], "request_json string")).collect()}
    assert (rows[""]["request_type"], rows[""]["force_reprocess"], rows[""]["request_error"]) == ("INCREMENTAL", False, None)
    assert str(rows[texts[1]]["date_to"]) == "2026-05-31"
    assert "file_date_from" in rows[texts[2]]["request_error"]
    assert rows[texts[3]]["request_type"] == "ADHOC" and rows[texts[3]]["request_paths"] == ["x.txt"]
    assert rows[texts[4]]["force_reprocess"] and rows[texts[4]]["request_paths"] == ["a", "b"]
    assert not rows[texts[5]]["force_reprocess"]
    assert rows[texts[6]]["request_error"] == "Unsupported request_type: REPLAY"
    assert all("JSON object" in rows[t]["request_error"] for t in texts[7:9])
    assert "modified_from_ts" in rows[texts[9]]["request_error"]
    words = spark.createDataFrame([(w,) for w in ("y", "YES", "True", " 1 ", "no", "", None)], "w string")
    assert [r[0] for r in words.select(truthy(F.col("w"))).collect()] == [True] * 4 + [False] * 3


def _listing(spark, rows):
    return spark.createDataFrame(rows, "feed_key string, file_name string, file_path string, file_fingerprint string, src_size bigint, src_mtime_ms bigint, parse_status string, file_date date")


def test_incremental_prefers_payload_lookback(spark):
    now = 1768478400000  # 2026-01-15 12:00Z
    parsed = _listing(spark, [("f", n, n, n, 1, m, "PARSED", None) for n, m in (("new", now - 30 * 60000), ("old", now - 200 * 60000), ("none", None), ("later", now + 1))])
    config = spark.createDataFrame([("f", "FILE_MODIFIED_TS", 60)], "feed_key string, sched_selector_type string, sched_lookback_minutes int")
    for payload, want in (('{"lookback_minutes":90}', {"new", "later"}), ('{"lookback_minutes":0}', {"new", "later"}), ('{"lookback_minutes":300}', {"new", "old", "later"})):
        ask = parse_request(spark.createDataFrame([("f", "r", "dbfs:/d", payload)], "feed_key string, request_id string, source_dir string, request_json string"))
        assert {r["file_path"] for r in selectors.select_paths(ask, parsed, config, "2026-01-15 12:00:00").collect()} == want


def test_explicit_paths(spark):
    ask = parse_request(spark.createDataFrame([("f", "r", "dbfs:/d", '{"request_type":"ADHOC","file_paths":["b.txt","/Volumes/x/a.txt","s3://k/c","b.txt"]}')],
                                              "feed_key string, request_id string, source_dir string, request_json string"))
    assert sorted(r["file_path"] for r in selectors.select_explicit(ask).collect()) == ["dbfs:/Volumes/x/a.txt", "dbfs:/d/b.txt", "s3://k/c"]


@pytest.mark.parametrize("events,blocked", [
    ([("STARTED", "2026-01-15 10:00:00")], True), ([("STARTED", "2026-01-15 10:00:00"), ("FAILED", "2026-01-15 11:00:00")], False),
    ([("STARTED", "2026-01-15 10:00:00"), ("SUCCEEDED", "2026-01-15 11:00:00")], False), ([("STARTED", "2026-01-01 10:00:00")], False),
    ([("FAILED", "2026-01-15 09:00:00"), ("STARTED", "2026-01-15 10:00:00")], True),
])
def test_blocked(spark, events, blocked):
    log = spark.createDataFrame([(str(i), "fp", "p", "INGEST_CONTROL", s, t) for i, (s, t) in enumerate(events)],
                                "event_id string, file_fingerprint string, file_path string, stage_name string, stage_status string, ts_event string")
    log = log.withColumn("ts_event", F.col("ts_event").cast("timestamp"))
    assert (waterfall.blocked_identities(log, "2026-01-15 12:00:00").count() == 1) is blocked


def _classified(spark, force):
    config = spark.createDataFrame([("f", r"^(x)_(\d+)\.txt$", "1|vendor_code|string")], "feed_key string, src_file_regex string, src_file_capture_spec string")
    listing = _listing(spark, [("f", n, f"d/{n}", f"fp_{n}", 1, 1, None, None) for n in ("x_1.txt", "x_2.txt", "x_3.txt", "bad.txt", "x_5.txt")])
    inv = spark.createDataFrame([("d/x_1.txt", "fp_x_1.txt", "LOADED_BRONZE"), ("d/x_2.txt", "other", "LOADED_BRONZE")], "file_path string, file_fingerprint string, load_status string")
    asked = spark.createDataFrame([("f", "r", f"d/{n}", force) for n in ("x_1.txt", "x_2.txt", "x_3.txt", "bad.txt", "x_4.txt", "x_5.txt")],
                                  "feed_key string, request_id string, file_path string, force_reprocess boolean")
    blocked = spark.createDataFrame([("fp_x_3.txt",), ("d/x_5.txt",)], "identity string")
    return waterfall.classify(asked, listing, config, inv, blocked)


def test_waterfall(spark):
    rows = {r["file_path"]: r for r in _classified(spark, False).collect()}
    assert {p for p, r in rows.items() if r["final_eligible"]} == {"d/x_2.txt"}
    assert {p for p, r in rows.items() if r["in_inventory"]} == {"d/x_1.txt", "d/x_2.txt"}
    assert rows["d/x_1.txt"]["status_reason"].startswith("already bronze loaded")
    assert rows["d/x_3.txt"]["status_reason"].startswith("blocked") and rows["d/x_5.txt"]["blocked_recent"]
    assert rows["d/bad.txt"]["status_reason"] == "request path is rejected" and not rows["d/x_4.txt"]["exists_in_source"]
    forced = {r["file_path"] for r in _classified(spark, True).collect() if r["final_eligible"]}
    assert forced == {"d/x_1.txt", "d/x_2.txt"}


def test_path_lists_partition_the_requested_set(spark):
    flags = _classified(spark, False)
    lists = {r["list_name"]: r["paths"] for r in waterfall.path_lists(flags).collect()}
    whole = lists["arr_paths_requested"]
    assert whole == sorted(whole) and len(whole) == 6
    for a, b in (("arr_paths_pattern_valid", "arr_paths_pattern_invalid"), ("arr_paths_exist", "arr_paths_missing"), ("arr_paths_final_eligible", "arr_paths_final_rejected")):
        assert sorted(lists.get(a, []) + lists.get(b, [])) == whole
    chunked = waterfall.path_lists(flags, 2).filter("list_name = 'arr_paths_requested'").orderBy("chunk_no").collect()
    assert [len(r["paths"]) for r in chunked] == [2, 2, 2] and sum((r["paths"] for r in chunked), []) == whole


def test_rows_of_path_lists_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(waterfall, "CHUNK_BYTES", 100)
    flags = _classified(spark, False).withColumn("file_path", F.concat(F.lit("x" * 60), "file_path"))
    rows = waterfall.path_lists(flags, 50).filter("list_name = 'arr_paths_requested'").orderBy("chunk_no").collect()
    assert all(sum(map(len, r["paths"][1:])) <= 100 for r in rows) and 3 <= len(rows) <= 6
    assert sum((r["paths"] for r in rows), []) == sorted(r["file_path"] for r in flags.collect())


def _next_fit(sizes, max_files, max_bytes):
    """Brute force: one batch number per file, in order."""
    out, count, total, number = [], 0, 0, 1
    for s in sizes:
        if count and (count >= max_files or total + s > max_bytes):
            number, count, total = number + 1, 0, 0
        out.append(number)
        count, total = count + 1, total + s
    return out


def _packed(spark, sizes, max_files, max_bytes, chunk=50_000):
    df = spark.createDataFrame([("f", f"p{i:05d}", s, f"fp{i}") for i, s in enumerate(sizes)], "feed_key string, file_path string, size bigint, file_fingerprint string")
    rows = batching.assign_batches(df, max_files, max_bytes, chunk).orderBy("file_path").collect()
    return [r["batch_no"] for r in rows]


@pytest.mark.parametrize("sizes,max_files,max_bytes,chunk", [
    ([10, 20, 30], 2, 10 ** 9, 50), ([1000] * 50, 2, 10 ** 9, 7), ([60, 60, 150, 10], 10, 100, 50), ([0, 0, 0, 5], 3, 1, 3), ([5], 1, 1, 1),
])
def test_packing_cases(spark, sizes, max_files, max_bytes, chunk):
    assert _packed(spark, sizes, max_files, max_bytes, chunk) == _next_fit(sizes, max_files, max_bytes)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 120), min_size=1, max_size=90), st.integers(1, 6), st.integers(1, 200), st.integers(6, 25))
def test_packing_equals_brute_force_over_chunks(spark, sizes, max_files, max_bytes, chunk):
    assert _packed(spark, sizes, max_files, max_bytes, chunk) == _next_fit(sizes, max_files, max_bytes)


def test_batches_and_refs(spark):
    df = spark.createDataFrame([("f", f"p{i:03d}", 1000, f"fp{i}") for i in range(50)], "feed_key string, file_path string, size bigint, file_fingerprint string")
    rows = batching.cap_batches(batching.pack_batches(df, 2, 10 ** 9), 10).orderBy("batch_no").collect()
    assert len(rows) == 25 and [r["batch_id"] for r in rows if r["in_run"]] == [f"batch_{i:03d}" for i in range(1, 11)]
    assert json.loads(rows[0]["batch_file_paths_json"]) == [{"path": "p000", "fingerprint": "fp0"}, {"path": "p001", "fingerprint": "fp1"}]
    assert rows[0]["total_size_bytes"] == 2000


def test_requests_pack_apart_and_limits_may_exceed_the_chunk(spark):
    rows = [("f", q, f"p{i:03d}", 1, f"fp{i}") for q in ("q1", "q2") for i in range(7)]
    df = spark.createDataFrame(rows, "feed_key string, request_id string, file_path string, size bigint, file_fingerprint string")
    made = batching.pack_batches(df, 5, 10 ** 9, chunk=3).collect()
    assert sorted((r["request_id"], r["batch_no"], r["file_count"]) for r in made) == [("q1", 1, 5), ("q1", 2, 2), ("q2", 1, 5), ("q2", 2, 2)]


def test_hot_keys_join_like_others(spark):
    facts = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").when(F.col("id") < 4500, F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    lookup = facts.filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = skew.lookup_join(facts, lookup, ["k"], "n", hot_rows=100, spread_by=F.col("id"))
    want = facts.join(lookup.drop("n"), "k", "left")
    assert got.count() == 5000 and got.exceptAll(want.select("k", "id", "top")).count() == 0


def test_positions_match_a_window(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 < 2, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"), F.xxhash64("id").alias("o"))
    got = skew.with_position(df.repartition(5), ["g"], [F.col("o")])
    from pyspark.sql import Window
    want = df.withColumn("position", (F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1).cast("bigint"))
    assert got.select("g", "o", "position").exceptAll(want).count() == 0 and got.count() == 3000


def test_a_file_is_of_the_first_sub_key_that_it_fits(spark):
    from feedyard.functions.filenames import parse_by_config

    config = spark.createDataFrame([("f", "b", r"^in-(\d+)\.txt$", "1|file_part_seq|int"), ("f", "a", r"^out-(\w+)\.txt$", "1|vendor_code|string"),
                                    ("f", "c", r"^(\w+)-.*\.txt$", "1|vendor_code|string"), ("g", "x", r"^(\w+)\.txt$", "1|vendor_code|string")],
                                   "feed_key string, feed_sub_key string, src_file_regex string, src_file_capture_spec string")
    files = spark.createDataFrame([("f", n) for n in ("in-7.txt", "out-q.txt", "in-x.txt", "none")] + [("g", "one.txt"), ("h", "of no feed")], "feed_key string, file_name string")
    got = {r["file_name"]: r for r in parse_by_config(files.withColumn("file_path", F.col("file_name")), config, ["feed_key", "file_path"], "left").collect()}
    assert len(got) == 6
    assert {n: r["feed_sub_key"] for n, r in got.items()} == {"in-7.txt": "b", "out-q.txt": "a", "in-x.txt": "c", "none": "a", "one.txt": "x", "of no feed": None}
    assert got["in-7.txt"]["file_part_seq"] == 7 and got["in-x.txt"]["vendor_code"] == "in" and got["none"]["parse_status"] == "PARSE_FAILED"


def test_batches_come_whole_from_the_chunk_they_start_in(spark):
    """The packed batches are those of the rows, whatever the chunk, also where batches cross its end and a fingerprint is missing."""
    rows = spark.createDataFrame([("f", f"p{i:03d}", 10 + i * 7 % 23, None if i % 9 == 0 else f"{i:064x}") for i in range(211)] + [("g", "q", 5, "x")],
                                 "feed_key string, file_path string, size bigint, file_fingerprint string")
    for chunk in (3, 7, 1000):
        one = {(r["feed_key"], r["batch_no"]): r for r in batching.pack_batches(rows, 5, 60, chunk).collect()}
        want = {}
        for r in batching.assign_batches(rows, 5, 60, chunk).collect():
            want.setdefault((r["feed_key"], r["batch_no"]), []).append(r)
        assert one.keys() == want.keys()
        for k, members in want.items():
            refs = [{"path": r["file_path"], **({"fingerprint": r["file_fingerprint"]} if r["file_fingerprint"] else {})} for r in sorted(members, key=lambda r: r["file_path"])]
            assert json.loads(one[k]["batch_file_paths_json"]) == refs
            assert (one[k]["file_count"], one[k]["total_size_bytes"]) == (len(members), sum(r["size"] for r in members))
    plan = batching.pack_batches(rows, 5, 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("collect_list(struct(path") == 0


def test_wide_rows_between_passes_are_kept_in_compressed_columns(spark):
    df = spark.range(1000).selectExpr("concat('dbfs:/Volumes/main/landing/feed/source/', id) AS p", "id").filter("id >= 0")
    again = kept(df)
    assert sorted(again.collect()) == sorted(df.collect()) and all(f.endswith(".zstd.parquet") for f in again.inputFiles())
    assert kept(df.filter("id < 0")).count() == 0


def test_stored_files_bound_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    """However narrow the stored numbers are, no file of theirs holds more rows than a task should make names of."""
    monkeypatch.setattr(views, "ROWS_PER_FILE", 700)
    stored = views.stored(spark, str(tmp_path), "numbers", lambda: spark.range(10_000).coalesce(2))
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name().alias("file")).count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) <= 700


def test_requested_paths_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = _classified(spark, False)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(feed_key#" not in re.sub(r"hashpartitioning\(feed_key#\d+, \d+\)", "", plan)  # by the feed alone they meet the configuration
        assert plan.count("hashpartitioning(_path#") == plan.count("hashpartitioning(_listed_path#") == plan.count("hashpartitioning(_print#") == 1
        assert {r["file_path"] for r in rows.collect() if r["final_eligible"]} == {"d/x_2.txt"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listed_entries_of_one_path_stay_apart_by_feed(spark):
    config = spark.createDataFrame([(f, r"^(x)_(\d+)\.txt$", "1|vendor_code|string") for f in ("f", "g", "h")], "feed_key string, src_file_regex string, src_file_capture_spec string")
    listing = spark.createDataFrame([
        ("f", "x_1.txt", "d/x_1.txt", "fp_f", 1), ("g", "x_1.txt", "d/x_1.txt", " fp_g ", 2), ("f", "x_7.txt", "d/other", "", 3), ("f", "x_1.txt", "d/x_1.txt", "fp_f", 1), ("f", "x_9.txt", None, "fp_n", 4)],
        "feed_key string, file_name string, file_path string, file_fingerprint string, src_size bigint")
    asked = spark.createDataFrame([(f, r, p, False) for f, r, p in (
        ("f", "r", "d/x_1.txt"), ("f", "s", "d/x_1.txt"), ("g", "r", "d/x_1.txt"), ("h", "r", "d/x_1.txt"), ("f", "r", "d/other"), ("f", "r", None), (None, "r", "d/x_1.txt"))],
        "feed_key string, request_id string, file_path string, force_reprocess boolean")
    inv = spark.createDataFrame([("e", "fp_g", "LOADED_BRONZE")], "file_path string, file_fingerprint string, load_status string")
    out = waterfall.classify(asked, listing, config, inv, spark.createDataFrame([("fp_f",)], "identity string"))
    rows = {(r["feed_key"], r["request_id"], r["file_path"]): r for r in out.collect()}
    assert len(rows) == 7
    assert rows["f", "r", "d/x_1.txt"]["blocked_recent"] and rows["f", "s", "d/x_1.txt"]["src_size"] == 1
    assert rows["g", "r", "d/x_1.txt"]["already_done"] and rows["g", "r", "d/x_1.txt"]["file_fingerprint"] == "fp_g" and rows["g", "r", "d/x_1.txt"]["src_size"] == 2
    assert not rows["h", "r", "d/x_1.txt"]["exists_in_source"] and not rows[None, "r", "d/x_1.txt"]["exists_in_source"] and not rows["f", "r", None]["exists_in_source"]
    named = rows["f", "r", "d/other"]
    assert named["file_name"] == "x_7.txt" and named["final_eligible"] and named["file_fingerprint"] == hashlib.sha256(b"d/other|none|none").hexdigest()


def test_sub_keys_are_tried_where_the_rows_are(spark, monkeypatch):
    config = spark.createDataFrame([
        ("f", "B", r"^(x)_(\d+)\.txt$", "1|vendor_code|string"), ("f", "A", r"^(y)_(\d+)\.txt$", "1|vendor_code|string"), ("f", None, r"^z$", "1|vendor_code|string"),
        ("f", "C", r"^([xy])_1\.txt$", "1|lob_code|string"), ("g", "Z", r"^(x)_(\d+)\.txt$", "1|lob_code|string")], "feed_key string, feed_sub_key string, src_file_regex string, src_file_capture_spec string")
    names = spark.createDataFrame([(f, n, f"{f}/{n}") for f in ("f", "g", "h") for n in ("x_1.txt", "y_1.txt", "y_2.txt", "none", "x_20.txt")], "feed_key string, file_name string, file_path string")

    def run(how, only=()):
        return filenames.parse_by_config(names, config, ["feed_key", "file_path"], how, only=only)

    for how in ("inner", "left"):
        near = run(how)
        assert "hashpartitioning(feed_key#" not in re.sub(r"hashpartitioning\(feed_key#\d+, \d+\)", "", near._jdf.queryExecution().executedPlan().toString())
        near = {(r["feed_key"], r["file_name"]): r.asDict() for r in near.collect()}
        with monkeypatch.context() as m:
            m.setattr(filenames, "SUB_KEYS_IN_PLACE", 0)
            assert near == {(r["feed_key"], r["file_name"]): r.asDict() for r in run(how).collect()}
        assert len(near) == (10 if how == "inner" else 15)
        assert [(near["f", n]["feed_sub_key"], near["f", n]["vendor_code"]) for n in ("x_1.txt", "y_2.txt", "none")] == [("B", "x"), ("A", "y"), (None, None)]
        assert near["g", "x_20.txt"]["lob_code"] == "x" and near["g", "y_1.txt"]["feed_sub_key"] == "Z"
    assert set(run("inner", ("lob_code",)).columns) == {"feed_key", "file_path", "lob_code", "feed_sub_key", "parse_status"}


def test_selected_paths_are_dealt_as_classification_needs_them(spark):
    feeds = spark.createDataFrame([("f", r"^(x)_(\d+)\.txt$", "1|vendor_code|string", "FILE_DATE", 5)], "feed_key string, src_file_regex string, src_file_capture_spec string, sched_selector_type string, sched_lookback_minutes int")
    listing = _listing(spark, [("f", n, f"d/{n}", f"fp_{n}", 1, 1, None, None) for n in ("x_1.txt", "x_2.txt", "bad.txt")])
    ask = parse_request(spark.createDataFrame([("f", "r", "d", '{"request_type":"DISCOVERY"}')], "feed_key string, request_id string, source_dir string, request_json string"))
    parsed = filenames.parse_by_config(listing.select("feed_key", "file_path", "file_name", "src_mtime_ms"), feeds, ["feed_key", "file_path"])
    paths = selectors.dealt_paths(ask, parsed, feeds, "2026-01-15").withColumn("force_reprocess", F.lit(False))
    inv = spark.createDataFrame([("d/x_1.txt", "fp_x_1.txt", "LOADED_BRONZE")], "file_path string, file_fingerprint string, load_status string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flags = waterfall.classify(paths, listing, feeds, inv, spark.createDataFrame([], "identity string"))
        assert flags._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(_path#") == 1
        assert {r["file_path"]: r["final_eligible"] for r in flags.collect()} == {"d/x_1.txt": False, "d/x_2.txt": True, "d/bad.txt": False}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chunks_inside_a_run_are_not_shuffled(spark):
    rows = spark.range(300).select(F.lit("f").alias("feed_key"), F.concat(F.lit("r"), F.col("id") % 2).alias("request_id"), F.format_string("p%04d", "id").alias("file_path"), *[
        (F.col("id") % n == 0).alias(c) for n, c in ((2, "pattern_valid"), (3, "exists_in_source"), (5, "blocked_recent"), (7, "already_done"), (11, "ready"), (13, "in_inventory"), (4, "final_eligible"))])
    rows = rows.withColumn("requested", F.lit(True))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        out = waterfall.path_lists(rows, 7)
        got, n = {}, 0
        for r in out.collect():
            got.setdefault((r["request_id"], r["list_name"]), {})[r["chunk_no"]] = r["paths"]
            n += 1
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    # chunks inside a run are grouped by the run too, where they are
    assert "Union" in plan and re.search(r"ObjectHashAggregate\(keys=\[feed_key#\d+, request_id#\d+, list_name#\d+, chunk_no#\d+, _pid#\d+\]", plan)
    assert n == sum(map(len, got.values()))
    for name, cond in waterfall.PATH_LISTS.items():
        held = {r["file_path"]: r for r in rows.filter(cond).collect()}
        for request in ("r0", "r1"):
            want = sorted(p for p, r in held.items() if r["request_id"] == request)
            chunks = [want[i:i + 7] for i in range(0, len(want), 7)]
            assert [c for _, c in sorted(got.get((request, name), {}).items())] == chunks, (request, name)
