"""Text members of ZIP archives."""
from __future__ import annotations

import io
import lzma
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from feedyard.sources.delimited import BATCH_LINES, read_first_line
from feedyard.sources.remote import open_input


# What damaged, encrypted and unusual archives raise, in their directory or while a member is read.
BROKEN = (OSError, ValueError, EOFError, RuntimeError, NotImplementedError, zipfile.BadZipFile, zlib.error, lzma.LZMAError)
LINE = "file_path string, member string, line_no bigint, line string, error string"


def is_text_member(name: str) -> bool:
    return not name.endswith("/") and name.lower().endswith(".txt")


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path in pdf["file_path"]:
            try:
                with open_input(path) as f, zipfile.ZipFile(f) as z:
                    found = [(path, n, _head(z, n), None) for n in sorted(filter(is_text_member, z.namelist()))]
                rows += found or [(path, None, None, f"No .txt files found inside zip: {path}")]
            except BROKEN as exc:
                rows.append((path, None, None, f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(rows, columns=["file_path", "member", "first_line", "error"])


def _head(z: zipfile.ZipFile, member: str) -> str:
    with z.open(member) as raw:
        return read_first_line(raw)


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["file_path", "member", "line_no", "line", "error"]
    for pdf in batches:
        for path, member in zip(pdf["file_path"], pdf["member"]):
            held = []
            try:
                with open_input(path) as f, zipfile.ZipFile(f) as z, z.open(member) as raw:
                    text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None)
                    for number, line in enumerate(text, 1):
                        held.append((path, member, number, line.rstrip("\n"), None))
                        if len(held) == BATCH_LINES:
                            yield pd.DataFrame(held, columns=names)
                            held = []
            except BROKEN as exc:
                held.append((path, member, None, None, f"{type(exc).__name__}: {exc}"))
            if held:
                yield pd.DataFrame(held, columns=names).astype({"line_no": "Int64"})


def list_members(archives: DataFrame) -> DataFrame:
    """The ``.txt`` members of each archive with their first line, or one row with the error of an archive that has none."""
    return archives.select("file_path").mapInPandas(_members, "file_path string, member string, first_line string, error string")


def scan_members(members: DataFrame) -> DataFrame:
    """``(file_path, member, line_no, line, error)`` of the given members.

    Each is streamed by its own task, a batch of lines at a time, so neither archives nor members are held in memory. A
    member that breaks off has the lines before the damage and one row with the error: it is the reader's to leave out what
    came of that archive.
    """
    return members.select("file_path", "member").repartition("file_path", "member").mapInPandas(_lines, LINE)


def scan_zip(archives: DataFrame) -> DataFrame:
    """``scan_members`` of all text members; only directories and first lines are read to find them."""
    return scan_members(list_members(archives).filter(F.col("member").isNotNull()))
