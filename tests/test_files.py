"""Files on disk: listings, headers, scans, archives, seeds, ingest, streams."""
import zipfile

import pytest
from pyspark.sql import functions as F

from feedyard.functions.fingerprints import enrich_listing
from feedyard import schemas
from feedyard.operators import bronze, commits, inventory, logs
from feedyard.plans import ingest
from feedyard.sources import archives, configs, delimited
from feedyard.sources.listing import list_files
from feedyard.streaming import flows

NOW = "2026-01-15 12:00:00"
FEED = ingest.Feed("f", r"^(\w+)\.(txt|zip)$", "1|vendor_code|string;2|file_extension|string", recipients=" ops ")


def _refs(spark, folder):
    return enrich_listing(list_files(spark, str(folder))).select("file_path", "file_name", "file_fingerprint")


@pytest.fixture
def drop(tmp_path):
    d = tmp_path / "drop"
    d.mkdir()
    (d / "h1.txt").write_text("report_id|report_status\n1|ok\n2|\"a|b\"\n")
    (d / "h3.txt").write_text(" report_id | d.e |x (y)/z\n3|4|5\n")
    (d / "h4.txt").write_text("report_id|report_status\n")
    (d / "with blank+plus%20.txt").write_text("report_id\n6\n")
    with zipfile.ZipFile(d / "z1.zip", "w") as z:
        z.writestr("inner/a.TXT", "report_id|report_status\n7|zip\n")
        z.writestr("inner/b.csv", "no\n")
    with zipfile.ZipFile(d / "z2.zip", "w") as z:
        z.writestr("m1.txt", "report_id|report_status\n8|m1\n")
        z.writestr("m2.txt", "report_status|extra|report_id\nm2|e|9\n")
    with zipfile.ZipFile(d / "z3.zip", "w") as z:
        z.writestr("b.csv", "no\n")
    (d / "sub").mkdir()
    (d / "sub" / "hidden.txt").write_text("report_id\n99\n")
    return d


def test_listing_is_flat(spark, drop):
    assert sorted(r["name"] for r in list_files(spark, str(drop)).collect()) == ["h1.txt", "h3.txt", "h4.txt", "with blank+plus%20.txt", "z1.zip", "z2.zip", "z3.zip"]


@pytest.fixture
def hidden(tmp_path):
    d = tmp_path / "hidden"
    d.mkdir()
    (d / "_x.txt").write_text("report_id|report_status\n1|a\n\n2|\"b|c\"\n")
    (d / ".y.txt").write_bytes(b"report_id|report_status\r\n3|d\r\n")
    (d / "z.txt").write_text("report_id|report_status\n4|e\n")
    (d / "_sub").mkdir()
    return d


def test_every_name_is_listed_and_loaded(spark, hidden, tmp_path):
    refs = _refs(spark, hidden)
    assert sorted(r["file_name"] for r in refs.collect()) == [".y.txt", "_x.txt", "z.txt"]
    feed = ingest.Feed("f", r"^([_.]?\w+)\.(txt|zip)$", "1|vendor_code|string;2|file_extension|string")
    rows = ingest.read_batch(spark, feed, refs, "b", None, None, NOW).rows
    assert sorted((r["report_id"], r["report_status"], r["src_file_name"]) for r in rows.collect()) == [
        ("1", "a", "_x.txt"), ("2", "b|c", "_x.txt"), ("3", "d", ".y.txt"), ("4", "e", "z.txt")]
    assert rows.filter("src_file_fingerprint IS NULL").count() == 0
    where = {"bronze_path": f"file:{tmp_path}/b", "log_dir": f"file:{tmp_path}/logs", "checkpoint": f"file:{tmp_path}/c"}
    flows.ingest_arrivals(spark, feed, f"file:{hidden}", now=NOW, **where)
    (hidden / "_late.txt").write_text("report_id\n5\n")
    for _ in range(2):
        flows.ingest_arrivals(spark, feed, f"file:{hidden}", now=NOW, **where)
    assert sorted(r["report_id"] for r in bronze.read_bronze(spark, where["bronze_path"]).collect()) == ["1", "2", "3", "4", "5"]


def test_listing_of_partitions(spark, tmp_path):
    for y, m in (("2024", "01"), ("2024", "02"), ("2025", "01")):
        (tmp_path / f"year={y}" / f"month={m}").mkdir(parents=True)
        (tmp_path / f"year={y}" / f"month={m}" / f"_{y}{m}.txt").write_text("x")
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "no.txt").write_text("x")
    rows = list_files(spark, f"file:{tmp_path}", partitions=True).collect()
    assert sorted((r["name"], r["year"], r["month"], r["size"]) for r in rows) == [("_202401.txt", "2024", "01", 1), ("_202402.txt", "2024", "02", 1), ("_202501.txt", "2025", "01", 1)]
    assert list_files(spark, f"file:{tmp_path}").count() == 0
    with pytest.raises(Exception, match="none"):
        list_files(spark, f"file:{tmp_path}/none").count()


def test_a_stream_reader_goes_on_from_its_log(tmp_path):
    from feedyard.sources import filesource
    d, log = tmp_path / "d", tmp_path / "log"
    d.mkdir()

    def reader():
        return filesource._StreamReader({"path": f"file:{d}", "log": f"file:{log}", "per_batch": "2"})

    taken, offset = [], 0
    for k in range(130):
        (d / f"_{k}.txt").write_text(str(k))
        one = reader() if k % 7 == 0 else one  # as after a restart
        end = one.latestOffset()["n"]
        for part in one.partitions({"n": offset}, {"n": end}):
            taken += [r for b in one.read(part) for r in b.column("name").to_pylist()]
        offset = end
    assert sorted(taken) == sorted(f"_{k}.txt" for k in range(130))
    assert reader().latestOffset() == {"n": offset} and (log / "all-0000000100.json").exists()


def test_lines_of_blocks(tmp_path):
    import io
    import random
    rng = random.Random(3)
    old = delimited.READ_BYTES
    try:
        for _ in range(300):
            delimited.READ_BYTES = rng.randint(1, 9)
            data = "".join(rng.choice(["a", "bc", "\n", "\r", "\r\n", ""]) for _ in range(rng.randint(0, 40))).encode()
            size = rng.randint(1, 12)
            got = [x for start in range(0, max(1, len(data)), size) for x in delimited.block_lines(io.BytesIO(data), start, start + size)]
            assert got == [x for x in data.splitlines()], (data, size)
    finally:
        delimited.READ_BYTES = old


def test_long_headers(spark, tmp_path, monkeypatch):
    long = "|".join(f"column_{i:06d}" for i in range(160_000))
    (tmp_path / "long.txt").write_text(long + "\n1|2\n")
    files = spark.createDataFrame([(f"file:{tmp_path}/long.txt",), ("nosuch://bucket/a b.txt",)], "file_path string")
    rows = {r["file_path"][:4]: r for r in delimited.read_headers(files, "|").collect()}
    assert len(rows["file"]["first_line"]) == len(long) > 2 << 20 and rows["file"]["columns"][-1] == "column_159999"
    assert rows["nosu"]["error"]
    monkeypatch.setattr(delimited, "HEAD_LIMIT", 1 << 20)
    with open(tmp_path / "long.txt", "rb") as f, pytest.raises(ValueError, match="no line end"):
        delimited.read_first_line(f)


def test_headers_and_missing_files(spark, drop):
    files = spark.createDataFrame([(f"file:{drop}/h3.txt",), (f"file:{drop}/gone.txt",)], "file_path string")
    rows = {r["file_path"].rsplit("/", 1)[1]: r for r in delimited.read_headers(files, "|").collect()}
    assert rows["h3.txt"]["columns"] == ["report_id", "d.e", "x (y)/z"] and rows["h3.txt"]["error"] is None
    assert "FileNotFoundError" in rows["gone.txt"]["error"]


def test_ingest_by_name_with_failures_of_single_files(spark, drop):
    refs = _refs(spark, drop)
    batch = ingest.read_batch(spark, FEED, refs, "batch_001", "r", "d", NOW)
    rows = {r["report_id"]: r.asDict() for r in batch.rows.collect()}
    assert set(rows) == {"1", "2", "3", "6", "7", "8", "9"}
    assert rows["2"]["report_status"] == "a|b" and rows["3"]["d.e"] == "4" and rows["3"]["x (y)/z"] == "5"
    assert rows["9"]["report_status"] == "m2" and rows["9"]["extra"] == "e" and rows["8"]["extra"] is None
    assert rows["7"]["src_file_name"] == "z1.zip" and rows["6"]["src_file_fingerprint"] and rows["1"]["feed_key"] == "f"
    report = ingest.report(FEED, batch, bronze.bronze_counts(batch.rows), ["report_id", "report_status"], "t", "batch_001", "r", "d", NOW)
    last = {(r["file_name"], r["stage_name"]): (r["stage_status"], r["cnt_row_written"]) for r in report.file_log.filter("stage_status <> 'STARTED'").collect()}
    assert last[("h1.txt", "INGEST_CONTROL")] == ("SUCCEEDED", 2) and last[("h4.txt", "BRONZE_LOAD")] == ("SUCCEEDED", 0)
    assert last[("z3.zip", "INGEST_CONTROL")] == ("FAILED", None) and ("z3.zip", "BRONZE_LOAD") not in last
    assert last[("z2.zip", "ZIP_EXTRACT")] == ("SUCCEEDED", 2)
    drifted = {r["file_name"]: r["change_detected"] for r in report.schema_changes.collect()}
    assert drifted["h1.txt"] == "N" and drifted["h3.txt"] == "Y"
    note = report.notifications.filter("message LIKE '%h3.txt%'").first()
    assert (note["severity"], note["event_type"], note["resolved_recipients"]) == ("WARNING", "SCHEMA_DRIFT_DETECTED", "ops")


def test_a_load_in_which_everything_fails(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "z.zip").write_bytes(b"no archive")
    with pytest.raises(RuntimeError, match="batch_007 failed"):
        ingest.read_batch(spark, FEED, _refs(spark, d), "batch_007", None, None, NOW)


def test_load_appends_grows_and_logs(spark, drop, tmp_path):
    table, log = f"file:{tmp_path}/bronze", f"file:{tmp_path}/logs"
    refs = _refs(spark, drop)
    first = ingest.load(spark, FEED, refs.filter("file_name = 'h1.txt'"), table, log, "batch_001", "r1", "d", NOW)
    assert [(r["cnt_row_bronze"], r["request_id"]) for r in first.collect()] == [(2, "r1")]
    ingest.load(spark, FEED, refs.filter("file_name = 'h3.txt'"), table, log, "batch_002", "r2", "d", NOW)
    rows = bronze.read_bronze(spark, table)
    assert rows.count() == 3 and {"report_status", "d.e"} <= set(rows.columns)
    assert spark.read.parquet(f"{log}/job_log").filter("task_status = 'SUCCEEDED'").count() == 2
    assert spark.read.parquet(f"{log}/file_log").count() == 6


def test_a_load_counts_its_own_rows_and_frees_its_files(spark, drop, tmp_path):
    from feedyard.operators.waterfall import blocked_identities
    table, log = f"file:{tmp_path}/bronze", f"file:{tmp_path}/logs"
    refs = _refs(spark, drop).filter("file_name IN ('h1.txt', 'h3.txt')")
    for n in (1, 2):
        done = ingest.load(spark, FEED, refs, table, log, f"batch_00{n}", None, None, NOW)
        assert sorted(r["cnt_row_bronze"] for r in done.collect()) == [1, 2]
    assert bronze.read_bronze(spark, table).count() == 6
    events = logs.read_log(spark, f"{log}/file_log", table)
    assert blocked_identities(events, NOW).count() == 0
    assert events.filter("stage_status = 'STARTED'").agg(F.max("ts_event")).first()[0] < events.filter("stage_status <> 'STARTED'").agg(F.min("ts_event")).first()[0]
    only_started = ingest.start_log(FEED, refs.filter("file_name = 'h1.txt'"), "batch_003", None, None, "2026-01-15 13:00:00")
    assert blocked_identities(events.unionByName(only_started), NOW).count() == 1


def test_two_streams_into_one_table(spark, drop, tmp_path):
    for k in (1, 2):
        flows.ingest_arrivals(spark, FEED, f"file:{drop}", f"file:{tmp_path}/b", f"file:{tmp_path}/logs", f"file:{tmp_path}/c{k}", NOW)
    assert bronze.read_bronze(spark, f"file:{tmp_path}/b").count() == 14


def test_no_header_and_repeated_names(spark, tmp_path):
    d = tmp_path / "plain"
    d.mkdir()
    (d / "a.txt").write_text("1,2,3\n4,5,6\n")
    feed = ingest.Feed("f", r"^(\w+)\.txt$", "1|vendor_code|string", delimiter=",", has_header=False)
    rows = ingest.read_batch(spark, feed, _refs(spark, d), "b", None, None, NOW).rows
    assert sorted((r["_c0"], r["_c2"]) for r in rows.collect()) == [("1", "3"), ("4", "6")]
    assert delimited.final_names(["a", "", "A", "b"]) == ["a0", None, "A2", "b"]


def test_line_numbers_over_splits(spark, tmp_path):
    d = tmp_path / "long"
    d.mkdir()
    (d / "l.txt").write_text("n\n" + "".join(f"{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        rows = delimited.scan_delimited(spark, [f"file:{d}/l.txt"], "|", True, ["n"])
        assert rows.rdd.getNumPartitions() > 10
        bad = delimited.number_lines(rows, True).filter(F.col("src_row_number") != F.col("n").cast("bigint") + 2)
        assert bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archives(spark, drop):
    rows = archives.list_members(list_files(spark, str(drop)).filter("name LIKE '%.zip'")).collect()
    assert sorted(r["member"] for r in rows if r["member"]) == ["inner/a.TXT", "m1.txt", "m2.txt"]
    assert [r["file_path"].rsplit("/", 1)[1] for r in rows if r["error"]] == ["z3.zip"]


@pytest.mark.parametrize("text,sep,want", [
    ("a| b |c\nx|y|z\n", "|", ["a", "b", "c"]), ("﻿a,b", ",", ["a", "b"]), ("", "|", []), (" \n ", "|", []),
    ("|".join(f"c{i}" for i in range(130)), "|", [f"c{i}" for i in range(130)]),
])
def test_schema_seed(spark, tmp_path, text, sep, want):
    (tmp_path / "seed.txt").write_text(text, encoding="utf-8")
    assert delimited.read_schema_seed(spark, f"file:{tmp_path}/seed.txt", sep) == want
    files = spark.createDataFrame([(f"file:{tmp_path}/seed.txt",), (f"file:{tmp_path}/none.txt",)], "file_path string")
    rows = {r["file_path"][-8:]: r for r in delimited.schema_seeds(files, sep).collect()}
    assert rows["seed.txt"]["columns"] == want and rows["none.txt"]["columns"] is None and rows["none.txt"]["error"]


def test_schema_seed_must_exist(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        delimited.read_schema_seed(spark, f"file:{tmp_path}/none.txt", "|")


def test_config_files_of_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿feed_key,sched_cron\nf1,0 0 * * * ?\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text('feed_key,src_file_regex\nf2,"^a,(b)"\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("feed_key,x\n")
    (tmp_path / "note.txt").write_text("no")
    rows = {r["feed_key"]: r for r in configs.scan_config(spark, f"file:{tmp_path}").collect()}
    assert set(rows) == {"f1", "f2"} and rows["f2"]["src_file_regex"] == "^a,(b)" and rows["f1"]["config_source_file"] == "a.csv"


def test_stream_takes_each_file_once(spark, drop, tmp_path):
    where = {"bronze_path": f"file:{tmp_path}/b", "log_dir": f"file:{tmp_path}/logs", "checkpoint": f"file:{tmp_path}/c"}
    flows.ingest_arrivals(spark, FEED, f"file:{drop}", now=NOW, **where)
    assert bronze.read_bronze(spark, where["bronze_path"]).count() == 7
    (drop / "late.txt").write_text("report_id\n10\n")
    flows.ingest_arrivals(spark, FEED, f"file:{drop}", now=NOW, **where)
    flows.ingest_arrivals(spark, FEED, f"file:{drop}", now=NOW, **where)
    assert bronze.read_bronze(spark, where["bronze_path"]).count() == 8


def test_a_load_that_dies_and_is_repeated_leaves_one_of_each(spark, drop, tmp_path, monkeypatch):
    table, log = f"file:{tmp_path}/bronze", f"file:{tmp_path}/logs"
    refs = _refs(spark, drop).filter("file_name IN ('h1.txt', 'h3.txt', 'z3.zip')")
    seed = ["report_id", "report_status"]
    where = {"spark": spark, "feed": FEED, "refs": refs, "bronze_path": table, "log_dir": log, "batch_id": "batch_001", "request_id": "r", "run_id": "d", "now": NOW,
             "policy": "SEED", "seed": seed}
    with monkeypatch.context() as broken:
        broken.setattr(commits, "publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            ingest.load(**where)
    assert commits.manifests(spark, table) is None and commits.known_columns(spark, table) is None
    assert bronze.read_bronze(spark, table).count() == 0  # written, but not committed
    assert {r["stage_status"] for r in logs.read_log(spark, f"{log}/file_log", table).collect()} == {"STARTED"}
    assert ingest.load(**where).count() == 2
    assert bronze.read_bronze(spark, table).count() == 3
    drift = {r["file_name"]: r["status_reason"] for r in logs.read_log(spark, f"{log}/schema_change_log", table).collect()}
    assert drift == {"h1.txt": "source columns match target schema", "h3.txt": "missing_in_file=report_status; new_in_file=d.e,x (y)/z"}
    events = logs.read_log(spark, f"{log}/file_log", table)
    assert events.filter("stage_status = 'STARTED'").count() == 3 and events.filter("stage_status <> 'STARTED'").count() == 5
    assert commits.known_columns(spark, table) == ["report_id", "report_status", "d.e", "x (y)/z"]
    # the next load is compared with the columns of all loads, whichever of them came first
    ingest.load(**{**where, "refs": _refs(spark, drop).filter("file_name LIKE 'with%'"), "batch_id": "batch_002"})
    last = logs.read_log(spark, f"{log}/schema_change_log", table).filter("file_name LIKE 'with%'").first()
    assert last["status_reason"] == "missing_in_file=report_status,d.e,x (y)/z"
    files = {r["file_name"]: r for r in commits.loaded_files(spark, table).collect()}
    assert sorted(files) == ["h1.txt", "h3.txt", "with blank+plus%20.txt"] and files["h1.txt"]["cnt_row_bronze"] == 2
    nothing = spark.createDataFrame([], schemas.INVENTORY)
    state = inventory.with_loads(nothing, commits.loaded_files(spark, table))
    assert {(r["file_name"], r["load_status"]) for r in state.collect()} == {(n, "LOADED_BRONZE") for n in files}


def test_a_load_in_which_all_fails_is_committed_as_failed(spark, drop, tmp_path):
    table, log = f"file:{tmp_path}/bronze", f"file:{tmp_path}/logs"
    refs = _refs(spark, drop).filter("file_name = 'z3.zip'")
    with pytest.raises(ingest.LoadFailed):
        ingest.load(spark, FEED, refs, table, log, "batch_001", "r", "d", NOW)
    assert [r["stage_status"] for r in logs.read_log(spark, f"{log}/file_log", table).orderBy("ts_event").collect()] == ["STARTED", "FAILED"]
    assert commits.loaded_files(spark, table).count() == 0 and commits.known_columns(spark, table) == []
    assert ingest.load(spark, FEED, _refs(spark, drop).filter("file_name = 'h1.txt'"), table, log, "batch_002", "r", "d", NOW).count() == 1


def test_a_stream_in_small_batches(spark, drop, tmp_path):
    where = {"bronze_path": f"file:{tmp_path}/b", "log_dir": f"file:{tmp_path}/logs", "checkpoint": f"file:{tmp_path}/c"}
    flows.ingest_arrivals(spark, FEED, f"file:{drop}", now=NOW, per_batch=3, **where)
    assert bronze.read_bronze(spark, where["bronze_path"]).count() == 7
    events = logs.read_log(spark, f"{tmp_path}/logs/file_log", where["bronze_path"])
    assert events.filter("stage_status = 'STARTED'").count() == 7 and events.select("request_id").distinct().count() == 3
    assert [r["file_name"] for r in events.filter("stage_status = 'FAILED'").collect()] == ["z3.zip"]


def _damaged(path, spoil):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("good.txt", "report_id|report_status\n20|lost\n")
        z.writestr("bad.txt", "report_id|report_status\n" + "".join(f"{i}|{i * 7919 % 1000}\n" for i in range(30_000)))
    data = bytearray(path.read_bytes())
    spoil(data)
    path.write_bytes(data)


def test_one_bad_archive_fails_alone(spark, drop, tmp_path):
    def cut_inside(data):
        at = len(data) // 2
        data[at:at + 200] = bytes(200)

    def encrypt(data):
        for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
            k = data.find(mark)
            while k >= 0:
                data[k + at] |= 1
                k = data.find(mark, k + 1)

    _damaged(drop / "torn.zip", cut_inside)
    _damaged(drop / "locked.zip", encrypt)
    table, log = f"file:{tmp_path}/bronze", f"file:{tmp_path}/logs"
    done = ingest.load(spark, FEED, _refs(spark, drop).filter("file_name LIKE '%.zip' OR file_name = 'h1.txt'"), table, log, "batch_001", "r", "d", NOW)
    assert sum(r["cnt_row_bronze"] for r in done.collect()) == 5  # h1 has two rows, z1 one, z2 two
    assert sorted({r["src_file_name"] for r in bronze.read_bronze(spark, table).select("src_file_name").collect()}) == ["h1.txt", "z1.zip", "z2.zip"]
    ended = logs.read_log(spark, f"{log}/file_log", table).filter("stage_name = 'INGEST_CONTROL' AND stage_status = 'FAILED'").collect()
    assert sorted(r["file_name"] for r in ended) == ["locked.zip", "torn.zip", "z3.zip"] and all("ingest failed: " in r["status_reason"] for r in ended)
    assert [r["task_status"] for r in logs.read_log(spark, f"{log}/job_log", table).collect()] == ["PARTIAL"]
