"""Token ids as binary shards: one zstandard frame per document and a trailing seek table with a checksum per frame.

A shard is a valid zstandard stream: a skippable header frame (JSON: the width of an id in bytes), the documents'
frames, a skippable frame with their identifiers, and the seek table of the seekable zstandard format. A reader takes the table from the end of
the file and decompresses only the frames that it wants.
"""
from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from feedyard.llm.bpe import BytePairCodec
from feedyard.llm.common import chunks, id_text
from feedyard.session import stable, work_dir

# Fixed values of the seekable format.
SKIPPABLE_HEADER, SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
# Distinct words kept packed per Python worker; beyond it the store starts anew.
WORDS_KEPT = 800_000
NO_ID = -(1 << 63)  # how a NULL identifier is written


class LibraryCodec(BytePairCodec):
    """Splits words as the parent does; new words are encoded by the tokenizers library and remembered as the bytes that a file holds."""

    def __init__(self, path: str, width: int) -> None:
        super().__init__(path)
        self.kind = f"<u{width}"
        self.packed: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def merge_words(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def pack_many(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text; a word met before costs one look-up, whatever its tokens."""
        if len(self.packed) > WORDS_KEPT:
            self.packed.clear()
        split = [self.words(t) for t in texts]
        new = list(set().union(*split).difference(self.packed))
        for word, ids in zip(new, self.merge_words(new)):
            self.packed[word] = np.array(ids, self.kind).tobytes()
        return [b"".join(map(self.packed.__getitem__, words)) for words in split]


def id_width(path: str, end_id: int) -> int:
    """Bytes of an id: two if all ids of the tokenizer's file and the end id fit, else four."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
    return 2 if top < 1 << 16 else 4


@lru_cache(maxsize=2)
def library_codec(path: str, end_id: int) -> LibraryCodec:
    return LibraryCodec(path, id_width(path, end_id))


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder's URI, as tasks can open it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


class ShardWriter:
    """Appends documents to one shard; ``close`` writes identifiers and seek table."""

    def __init__(self, sink, width: int, level: int = 3) -> None:
        self.sink, self.width = sink, width
        self.press = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.ids: list[int] = []
        self.table: list[bytes] = []
        head = json.dumps({"id_bytes": width}).encode()
        self._frame(struct.pack("<II", SKIPPABLE_HEADER, len(head)) + head, b"")

    def _frame(self, frame: bytes, content: bytes) -> None:
        self.sink.write(frame)
        self.table.append(struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, content: bytes) -> None:
        """Append a document of little-endian ids."""
        self._frame(self.press.compress(content), content)
        self.ids.append(NO_ID if doc_id is None else doc_id)

    def close(self) -> None:
        ids = self.press.compress(np.array(self.ids, "<i8").tobytes())
        self._frame(struct.pack("<II", SKIPPABLE_IDS, len(ids)) + ids, b"")
        entries = b"".join(self.table)
        self.sink.write(struct.pack("<II", SKIPPABLE_TABLE, len(entries) + 9) + entries
                        + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE))


class ShardReader:
    """Documents of one shard by position; reads the table first and then only the frames asked for."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the shard")
        table = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.length, self.sums = table[1:-1, 1], table[1:-1, 2]
        self.width = json.loads(self._at(8, int(table[0, 0]) - 8))["id_bytes"]
        self.open = zstandard.ZstdDecompressor()
        packed = self._at(int(self.begin[-2]) + 8, int(table[-1, 0]) - 8)
        ids = np.frombuffer(self.open.decompress(packed, max_output_size=8 * (count - 2) + 1), "<i8")
        self.ids = [None if i == NO_ID else int(i) for i in ids]

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.ids)

    def tokens(self, position: int) -> np.ndarray:
        frame = self._at(int(self.begin[position + 1]), int(self.begin[position + 2] - self.begin[position + 1]))
        content = self.open.decompress(frame, max_output_size=int(self.length[position]) + 1)
        if len(content) != self.length[position] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[position]:
            raise ValueError(f"document {position} of the shard is damaged")
        return np.frombuffer(content, f"<u{self.width}")


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all rows and write them in ascending id order into shards in ``folder``.

    Returns the manifest, one row per shard: ``(shard, path, n_docs, n_tokens, start)``; ``start`` counts the ids of all
    shards before it. Rows are range-partitioned by id (NULL first; repeated ids by text), so each task writes one
    shard; a repeated task writes a file of its own and the manifest, which is checkpointed, names the valid one. NULL
    and empty texts hold only the end id. An empty table has an empty manifest.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, at, writer, total = library_codec(tokenizer, end_id), TaskContext.get(), None, 0
        width = np.dtype(c.kind).itemsize
        end = end_id.to_bytes(width, "little")
        fs, base = file_system(folder)
        name = f"shard-{at.partitionId():06d}-{at.taskAttemptId()}.tok"
        sink = None
        for ids, bodies in chunks(batches):
            if writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{name}")
                writer = ShardWriter(sink, width)
            for i, content in zip(ids, c.pack_many([b.decode() for b in bodies])):
                writer.add(i, content + end)
                total += len(content) // width + 1
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([at.partitionId()], pa.int32()), "path": [f"{folder}/{name}"],
                                              "n_docs": pa.array([len(writer.ids)], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("body"))
    manifest = stable(rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "body").drop("tie")
                      .mapInArrow(run, "shard int, path string, n_docs bigint, n_tokens bigint"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the shards: offset and checksum of its ids as 32-bit integers."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = file_system(row["path"])
                with fs.open_input_file(path) as source:
                    shard, start, out = ShardReader(source), row["start"], []
                    for k in range(len(shard)):
                        tokens = shard.tokens(k).astype("<u4")
                        out.append((shard.ids[k], start, len(tokens), zlib.crc32(tokens.tobytes())))
                        start += len(tokens)
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = manifest.select("shard", "path", "start")
    # by number, so that few small rows are not put together: each stands for a whole file
    return shards.repartitionByRange(max(1, manifest.count()), "shard").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, ids array<int>)`` of the documents named in ``wanted(shard, position)``; only their frames are decompressed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard, source = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != name:
                    if source is not None:
                        source.close()
                    fs, path = file_system(row["path"])
                    source = fs.open_input_file(path)
                    name, shard = row["path"], ShardReader(source)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.ids[row["position"]]], pa.int64()),
                     pa.array([shard.tokens(row["position"]).astype(np.int32)], pa.list_(pa.int32()))], ["doc_id", "ids"])

    asked = wanted.select("shard", "position").join(manifest.select("shard", "path"), "shard")
    return asked.repartition("path").sortWithinPartitions("path", "position").select("path", "position").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all rows with :func:`write_shards` (into the shared folder unless one is given) and read them back."""
    folder = folder or work_dir(docs.sparkSession, "token-files")
    return read_shards(write_shards(docs, tokenizer, end_id, folder, id_col, text_col))
