"""``feed_files``: a data source that lists folders, in batch and as a stream.

Spark's own file sources leave out names that begin with ``_`` or ``.``; a delivery may be called so. Here every name counts.
Contents are not read. Options: ``path``, a qualified folder; ``partitions`` (``true`` lists ``key=value`` sub-folders as
well); for streams ``log``, a folder of the stream's own, and ``per_batch``, the most files that one offset adds.
"""
from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from feedyard.sources.remote import entries, read_bytes, write_bytes

SCHEMA = "path string, name string, length bigint, modified_ms bigint, keys map<string,string>"
ARROW = pa.schema([("path", pa.string()), ("name", pa.string()), ("length", pa.int64()), ("modified_ms", pa.int64()), ("keys", pa.map_(pa.string(), pa.string()))])
BATCH = 10_000
# So often the stream's log gets a list of all names so far, from which a restart goes on.
COMPACT = 50

Found = tuple[str, str, int, int, list]


def _rows(found: list[Found]) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(found), BATCH):
        columns = zip(*found[begin:begin + BATCH])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)


def _files(folder: str, keys: list) -> list[Found]:
    return [(f"{folder.rstrip('/')}/{e.name}", e.name, e.size, e.modified_ms, keys) for e in entries(folder) if e.is_file]


def _folders(root: str, partitioned: bool) -> list[tuple[str, list]]:
    """The folders to list with the keys they stand for: the root, and below it all ``key=value`` folders."""
    out, open_ = [], [(root.rstrip("/"), [])]
    while open_:
        folder, keys = open_.pop()
        out.append((folder, keys))
        if partitioned:
            for e in entries(folder):
                key, is_key, value = e.name.partition("=")
                if not e.is_file and is_key and key:
                    open_.append((f"{folder}/{e.name}", [*keys, (key, value)]))
    return out


class Folder(InputPartition):
    def __init__(self, path: str, keys: list):
        self.path, self.keys = path, keys


class LogEntry(InputPartition):
    def __init__(self, number: int):
        self.number = number


class _Reader(DataSourceReader):
    """One partition per folder; each is listed by its own task."""

    def __init__(self, options):
        self.root, self.partitioned = options["path"], str(options.get("partitions", "false")).lower() == "true"

    def partitions(self) -> list[Folder]:
        return [Folder(*f) for f in _folders(self.root, self.partitioned)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        yield from _rows(_files(partition.path, partition.keys))


class _StreamReader(DataSourceStreamReader):
    """New names in order of arrival. An offset is the number of an entry of the stream's log, which is written before Spark learns of it.

    So a batch that is repeated reads the same files, and files of an entry that Spark had not recorded when the stream
    died are in the next offset. A name counts once, as in Spark's file stream.
    """

    def __init__(self, options):
        self.root, self.partitioned = options["path"], str(options.get("partitions", "false")).lower() == "true"
        self.log, self.per_batch = options["log"].rstrip("/"), int(options.get("per_batch", 0))
        self.seen: set[str] | None = None
        self.number = 0

    def initialOffset(self) -> dict:
        return {"n": 0}

    def _entry(self, number: int) -> list[Found]:
        return [tuple(r) for r in json.loads(read_bytes(f"{self.log}/{number:010d}.json"))]

    def _recover(self) -> None:
        names = sorted(e.name for e in entries(self.log, missing_ok=True) if e.is_file and e.name.endswith(".json"))
        numbers = [int(n[:-5]) for n in names if n[:-5].isdigit()]
        whole = max((int(n[4:-5]) for n in names if n.startswith("all-")), default=0)
        self.seen = set(json.loads(read_bytes(f"{self.log}/all-{whole:010d}.json"))) if whole else set()
        self.number = max(numbers, default=0)
        for k in range(whole + 1, self.number + 1):
            self.seen.update(r[0] for r in self._entry(k))

    def latestOffset(self) -> dict:
        if self.seen is None:
            self._recover()
        fresh = [f for folder, keys in _folders(self.root, self.partitioned) for f in _files(folder, keys) if f[0] not in self.seen]
        if fresh:
            fresh.sort(key=lambda f: (f[3], f[0]))
            fresh = fresh[:self.per_batch] if self.per_batch else fresh
            write_bytes(f"{self.log}/{self.number + 1:010d}.json", json.dumps(fresh).encode())
            self.number += 1
            self.seen.update(f[0] for f in fresh)
            if self.number % COMPACT == 0:
                write_bytes(f"{self.log}/all-{self.number:010d}.json", json.dumps(sorted(self.seen)).encode())
        return {"n": self.number}

    def partitions(self, start: dict, end: dict) -> list[LogEntry]:
        return [LogEntry(n) for n in range(start["n"] + 1, end["n"] + 1)]

    def read(self, partition: LogEntry) -> Iterator[pa.RecordBatch]:
        yield from _rows([(*f[:4], [tuple(k) for k in f[4]]) for f in self._entry(partition.number)])

    def commit(self, end: dict) -> None:
        """Nothing to do: the log stays, since it is what tells known names from new ones."""

    def stop(self) -> None:
        """Nothing is held open."""


class FeedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options)
