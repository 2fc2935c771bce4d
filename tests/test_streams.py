"""Streams: tracked state that expires, windows closed and open, loads that are committed once."""
import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from feedyard.checks import streams
from feedyard.streaming import flows, tracking

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
EVENTS = "event_id string, file_fingerprint string, file_path string, stage_name string, stage_status string, ts_event timestamp"


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _event(n, who, hours, status):
    return f"ev_{n:06d}", f"fp_{who}" if who % 3 else " ", f"/p/{who}", "INGEST_CONTROL", status, T0 + timedelta(hours=hours)


def _stream(spark, path):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(path))


def _files(folder: Path) -> int:
    return sum(1 for p in folder.rglob("*") if p.is_file())


def test_state_is_bounded_and_equals_the_log(spark, tmp_path, one_partition):
    """Fifty micro-batches: identities come and go, events are out of order by up to a day, one identity has most of them."""
    rng, events, sizes = random.Random(1), [], []
    checkpoint = tmp_path / "state"
    for leg in range(5):
        for step in range(10 * leg, 10 * leg + 10):
            rows = [_event(len(events) + k, 1 if k < 12 else step * 3 + k, step * 6 - rng.randint(0, 24), rng.choice(["STARTED", "SUCCEEDED"])) for k in range(20)]
            events += rows
            spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        tracking.track_latest(_stream(spark, tmp_path / "in"), str(checkpoint))
        sizes.append(_files(checkpoint / "state"))
        newest = max(e[5] for e in events)
        last = {}
        for e in events:
            if e[5] >= newest - timedelta(hours=48):
                who = e[1].strip() or e[2]
                last[who] = max(last.get(who, (T0 - timedelta(days=9), "", "")), (e[5], e[0], e[4]))
        got = {r["identity"]: r["stage_status"] for r in tracking.tracked_status(spark, str(checkpoint)).collect()}
        assert got == {who: v[2] for who, v in last.items()}
        assert {r["identity"] for r in tracking.current_blocked(spark, str(checkpoint)).collect()} == {w for w, v in last.items() if v[2] == "STARTED"}
    assert len({e[1].strip() or e[2] for e in events}) > 2 * len(got)  # most identities are forgotten
    assert sizes[-1] < 2 * sizes[0]


def test_windows_closed_and_open(spark, tmp_path, one_partition):
    for day in range(3):
        rows = [_event(k, k % 5, 24 * day + k, ["STARTED", "FAILED"][k % 2]) for k in range(24)]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        counts = flows.stage_counts(_stream(spark, tmp_path / "in"))
        tracking.count_stages(counts, str(tmp_path / "out"), str(tmp_path / "cp"))
        got = tracking.counted_stages(spark, str(tmp_path / "out"), str(tmp_path / "cp"))
        assert got.count() == got.select("hour_start").distinct().count() == 24 * (day + 1)
        assert got.agg({"cnt": "sum"}).first()[0] == 24 * (day + 1)


def test_micro_batches_do_not_grow_with_the_files(spark, tmp_path, one_partition):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    stream = streams._log_stream(spark, str(tmp_path))
    tracking.track_latest(stream.filter("stage_name = 'INGEST_CONTROL'"), str(tmp_path / "state"))
    last = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    assert 3 <= last <= 4  # numbered from 0; one more may only move the watermark
    assert tracking.tracked_status(spark, str(tmp_path / "state")).count() > 0


def test_tracking_needs_no_python_worker(spark, tmp_path, one_partition):
    """One identity of nearly all events: they are reduced before the shuffle, in the engine itself."""
    rows = [_event(k, 1 if k else 2, k % 30, "STARTED" if k % 2 else "FAILED") for k in range(2000)]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    tracking.track_latest(_stream(spark, tmp_path / "in"), str(tmp_path / "state"))
    metadata = "".join(p.read_text() for p in (tmp_path / "state" / "state" / "0" / "_metadata").rglob("*") if p.is_file() and not p.name.startswith("."))
    assert "stateStoreSave" in metadata and "transformWithState" not in metadata
    top = {r["identity"]: (r["event_id"], r["stage_status"]) for r in tracking.tracked_status(spark, str(tmp_path / "state")).collect()}
    assert top["fp_1"] == max((rows[k][5], rows[k][0], rows[k][4]) for k in range(1, 2000))[1:]
