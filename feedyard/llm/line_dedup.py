"""Repeated lines across documents: two Bloom filters find suspects, only suspects are shuffled and settled exactly."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from feedyard.llm.common import chunks, id_text
from feedyard.session import stable

MIN_POINTS = 10
WHITE = b"\t\n\x0b\x0c\r "
# Bits of each filter: 16 MiB in all, whatever the input, so it can be sent to every executor. A fuller filter
# suspects more lines than repeat; those are shuffled too and found innocent, so results do not depend on it.
FILTER_BITS = 1 << 27
SEGMENTS = 64
PROBES = 3


def line_keys(body: bytes) -> dict[bytes, list[int]]:
    """Keys of a text that are long enough, each with the positions of its lines."""
    out: dict[bytes, list[int]] = {}
    for at, line in enumerate(body.split(b"\n")):
        key = line.strip(WHITE).lower()  # of bytes: lowers A-Z alone
        if len(key) >= MIN_POINTS and (len(key) >= 4 * MIN_POINTS or len(key.decode()) >= MIN_POINTS):
            out.setdefault(key, []).append(at)
    return out


def probes(keys: Iterable[bytes], bits: int) -> np.ndarray:
    """Bit positions of each key, one row per key."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * high[:, None]) % np.uint64(bits)).astype(np.int64)


def _pack(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(flags.tobytes())


def _unpack(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=size), np.uint8)


def _unite(one: tuple, other: tuple) -> tuple:
    """Once-seen and twice-seen of two sets of documents together; both are sets of bits, so the order does not matter."""
    return one[0] | other[0], one[1] | other[1] | (one[0] & other[0])


def repeated_filter(docs: DataFrame, id_col: str, text_col: str, bits: int = FILTER_BITS) -> bytes:
    """The twice-seen filter over all documents: every key of two documents has all its bits set.

    Each task keeps both filters for its own documents and emits them in compressed segments, whose size follows the
    number of lines. Segments are united over (segment, group of tasks) and then over segments. Two filters meet as
    ``once = a | b`` and ``twice = a2 | b2 | a & b``. Only the twice-seen segments, ``bits`` in all, reach the driver.
    """
    size = bits // SEGMENTS // 8

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        any_rows = False
        for _, bodies in chunks(batches):
            any_rows = True
            for body in bodies:
                at = probes(line_keys(body), bits)
                word, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
                seen = ((once[word] & bit) != 0).all(1)
                np.bitwise_or.at(once, word.ravel(), bit.ravel())
                if seen.any():
                    np.bitwise_or.at(twice, word[seen].ravel(), bit[seen].ravel())
        if any_rows:
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(range(SEGMENTS), pa.int32()),
                "once": [_pack(x) for x in once.reshape(SEGMENTS, size)], "twice": [_pack(x) for x in twice.reshape(SEGMENTS, size)]})

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by segment; one united segment is held at a time."""
        key, held = None, None

        def out():
            return pa.RecordBatch.from_pydict({"segment": pa.array([key], pa.int32()), "once": [_pack(held[0])], "twice": [_pack(held[1])]})

        for batch in batches:
            for row in batch.to_pylist():
                new = _unpack(row["once"], size), _unpack(row["twice"], size)
                if row["segment"] == key:
                    held = _unite(held, new)
                else:
                    if key is not None:
                        yield out()
                    key, held = row["segment"], new
        if key is not None:
            yield out()

    kind = "segment int, once binary, twice binary"
    parts = id_text(docs, id_col, text_col).mapInArrow(build, kind).withColumn("group", F.spark_partition_id() % 32)
    for keys in (["segment", "group"], ["segment"]):
        parts = parts.repartition(*keys).sortWithinPartitions(*keys).select("segment", "once", "twice").mapInArrow(unite, kind)
        if keys != ["segment"]:
            parts = parts.withColumn("group", F.lit(0))
    whole = bytearray(bits // 8)
    for row in parts.select("segment", "twice").collect():  # SEGMENTS rows of bits / SEGMENTS at most
        whole[row.segment * size:(row.segment + 1) * size] = _unpack(row.twice, size).tobytes()
    return bytes(whole)


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """With a hash of the text, so that rows of one id and different texts are told apart."""
    return id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("body"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """``(id, tag, lines array<int>)``: which lines each document loses; documents that lose none are absent."""
    spark = docs.sparkSession
    twice = spark.sparkContext.broadcast(repeated_filter(docs, id_col, text_col, bits))

    def suspects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            rows: list[tuple] = []
            for i, body, tag in zip(*(batch.column(k).to_pylist() for k in range(3))):
                keys = line_keys(body)
                at = probes(keys, bits)
                hit = ((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1) if len(at) else []
                rows += [(i, tag, key, lines) for (key, lines), h in zip(keys.items(), hit) if h]
            if rows:
                kinds = pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], ["id", "tag", "key", "lines"])

    found = _tagged(docs, id_col, text_col).mapInArrow(suspects, "id bigint, tag bigint, key binary, lines array<int>")
    least = found.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # a table of its own, so that the join below reads two plain exchanges and a frequent line can be split over tasks
    repeated = stable(least.filter("first < last").select("key", "first"))
    lost = found.join(repeated, "key").filter("id > first")
    return lost.groupBy("id", "tag").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)`` of every row.

    A line's key is the line without white space at both ends, A-Z lowered. Keys of at least ten code points that occur
    in two documents stay only in the one with the smallest id; there all their lines stay. NULL and empty texts are
    one empty line. Rows of one id count as one document, so they take no lines from each other;
    a NULL id is never compared and loses nothing. If every line goes the kept text is empty.
    """
    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost = batch.column(2).to_pylist()
            out = []
            for body, drop in zip(batch.column(1).to_pylist(), lost):
                lines = body.split(b"\n")
                gone = {x for x in drop or () if x < len(lines)}
                kept = b"\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else body
                out.append((len(lines), len(gone), kept.decode()))
            n, d, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d, pa.int64()), pa.array(kept, pa.string())],
                                             ["doc_id", "n_lines", "n_dropped", "kept_text"])

    lost = dropped_lines(docs, id_col, text_col, bits)
    return _tagged(docs, id_col, text_col).join(lost, ["id", "tag"], "left").select("id", "body", "lines").mapInArrow(
        rewrite, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")
