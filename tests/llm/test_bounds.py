"""What stages of a corpus hold at a time: open stores, batches, pairs of a group, files of small shuffles."""
import importlib
import tracemalloc

import pyarrow as pa

from feedyard.llm import common, exact_dedup, near_dedup

components_module = importlib.import_module("feedyard.llm.components")


def test_exact_stores_are_closed(spark, frame, tmp_path):
    """Stores that stay open hold native memory of the executor while later stages run."""
    opened = spark._jvm.org.apache.spark.sql.execution.streaming.state.RocksDBMemoryManager.getNumRocksDBInstances
    frame([(1, "a"), (2, "a"), (3, "b")]).write.parquet(str(tmp_path / "docs"))
    before = opened(True)
    exact_dedup.update_state(spark, str(tmp_path / "docs"), str(tmp_path / "state"))
    assert opened(True) <= before


def test_rows_go_to_workers_in_few_bytes(spark, frame):
    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    rows = common.id_text(frame([(i, "x" * 10_000) for i in range(1500)]).coalesce(1)).mapInArrow(held, "n bigint")
    sizes = [r["n"] for r in rows.collect()]
    assert sum(sizes) > 15_000_000 and max(sizes) < common.BATCH_BYTES + 100_000


def test_pairs_of_a_group_are_held_some_at_a_time():
    n = 600
    sig = near_dedup.signature(near_dedup.shingles(b"one two three four five six"))
    group = pa.table({"key": pa.array([0] * n, pa.int64()), "i": [0] * n, "j": [0] * n, "own": [0] * n, "root": pa.array(range(n), pa.int64()), "n": [2] * n,
                      "sig": pa.array([sig] * n, pa.binary())})
    tracemalloc.start()
    met = sum(len(i) for i, _, _ in near_dedup._candidates(group))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert met == n * (n - 1) // 2 and peak < 64 << 20


def test_few_edges_take_few_tasks(spark, monkeypatch):
    """Each task that writes a shuffle leaves files, however few edges it has."""
    taken, real = [], components_module.stable

    def counted(df):
        taken.append(real(df))
        return taken[-1]

    monkeypatch.setattr(components_module, "stable", counted)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = components_module.components(spark.createDataFrame([(i, i + 1) for i in range(20)], "a bigint, b bigint")).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {tuple(r) for r in got} == {(i, 0) for i in range(21)}
    assert all(df.rdd.getNumPartitions() == 1 for df in taken[1:])
