"""Delimited text: headers, rows and line numbers."""
from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from feedyard.functions.text import col_q, strip
from feedyard.session import stable
from feedyard.sources.listing import plain_path
from feedyard.sources.remote import open_input

HEAD_BYTES = 1024 * 1024
# A first line may be longer than one read, but not without end: a file whose line exceeds this fails by itself.
HEAD_LIMIT = 64 * HEAD_BYTES
BLOCK_BYTES = 64 << 20
READ_BYTES = 1 << 20
BATCH_LINES = 10_000
META = ("_file_path", "_block_start", "_row_id")


def first_line(data: bytes) -> str:
    lines = data.decode("utf-8", errors="ignore").splitlines()
    return lines[0] if lines else ""


def read_first_line(source) -> str:
    """The first line of an open binary file, read on to its end."""
    data = b""
    while len(data) <= HEAD_LIMIT:
        piece = source.read(HEAD_BYTES)
        data += piece
        if not piece or b"\n" in piece or b"\r" in piece:
            return first_line(data)
    raise ValueError(f"no line end within the first {HEAD_LIMIT} bytes")


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path in pdf["file_path"]:
            try:
                with open_input(path) as f:
                    rows.append((path, read_first_line(f), None))
            except (OSError, ValueError) as exc:  # Arrow reports an unknown scheme as a ValueError
                rows.append((path, None, f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(rows, columns=["file_path", "first_line", "error"])


def split_header(line, sep: str):
    """Column names of a header line, trimmed; none from a blank line."""
    names = F.transform(F.split(line, _literal(sep)), strip)
    return F.when(strip(F.coalesce(line, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(names)


def read_headers(files: DataFrame, sep: str, has_header: bool = True) -> DataFrame:
    """First line and column names of each file, read up to the end of that line only.

    Small reads spread over tasks, so headers never cost a scan of the data. A file that cannot be
    opened, or whose first line does not end, keeps its row, with the error.
    """
    heads = files.select("file_path").mapInPandas(_heads, "file_path string, first_line string, error string")
    names = split_header(F.col("first_line"), sep) if has_header else F.array().cast("array<string>")
    width = F.size(F.split(F.coalesce("first_line", F.lit("")), _literal(sep)))
    return heads.withColumns({"columns": names, "width": width})


def _literal(sep: str) -> str:
    return r"\Q" + sep + r"\E"


def final_names(columns: list[str]) -> list[str | None]:
    """Names as loaded: repeated names get their position as suffix, blank ones no column."""
    low = [c.lower() for c in columns]
    return [None if not c else c if low.count(c.lower()) == 1 else f"{c}{i}" for i, c in enumerate(columns)]


def scan_delimited(spark: SparkSession, paths: list[str], sep: str, has_header: bool, columns: list[str] | None = None,
                   width: int | None = None) -> DataFrame:
    """Rows of files that share one header, all text, with file, block and row id.

    ``columns`` are the trimmed header names; files without header get ``_c0``, ``_c1``, ... Files
    with other headers belong in another scan, since columns are read by position.
    """
    names = final_names(columns) if columns else [f"_c{i}" for i in range(width or 1)]
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    rows = spark.read.option("sep", sep).option("header", has_header).schema(schema).csv(paths)
    return rows.select(
        *[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n is not None],
        plain_path(F.col("_metadata.file_path")).alias("_file_path"), F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_id"),
    )


_LINE_END = re.compile(rb"\r\n|\n|\r")


def block_lines(source, start: int, end: int) -> Iterator[bytes]:
    """Lines of an open binary file that begin in ``[start, end)``, without their ends; each line belongs to one block."""
    source.seek(max(0, start - 1))
    at, data, skipping, final = max(0, start - 1), b"", start > 0, False
    while True:
        begin = 0
        for m in _LINE_END.finditer(data):
            if m.end() == len(data) and m.group() == b"\r" and not final:
                break  # its line feed may be in the next read
            if not skipping:
                if at + begin >= end:
                    return
                yield data[begin:m.start()]
            skipping, begin = False, m.end()
        at, data = at + begin, data[begin:]
        if final:
            break
        piece = source.read(READ_BYTES)
        final = not piece
        data += piece
    if data and not skipping and at < end:
        yield data


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path in pdf["file_path"]:
            with open_input(path) as f:
                rows += [(path, start) for start in range(0, max(1, f.size()), BLOCK_BYTES)]
        yield pd.DataFrame(rows, columns=["file_path", "start"])


def _block_rows(has_header: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), pa.array([start] * len(held), pa.int64()), pa.array(range(number - len(held), number), pa.int64()),
                                               pa.array([x.decode("utf-8", "replace") for x in held], pa.string())], ["file_path", "start", "row", "line"])

        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, number = [], 0
                with open_input(path) as f:
                    for k, line in enumerate(block_lines(f, start, start + BLOCK_BYTES)):
                        if (has_header and start == 0 and k == 0) or not line.strip():
                            continue
                        held.append(line)
                        number += 1
                        if len(held) == BATCH_LINES:
                            yield out()
                            held = []
                if held:
                    yield out()
    return run


def scan_hidden(files: DataFrame, sep: str, has_header: bool, columns: list[str] | None = None, width: int | None = None) -> DataFrame:
    """``scan_delimited`` of ``files`` (file_path) that Spark's own sources leave out because of their names.

    Blocks of a file are read by tasks of their own and parsed by the same CSV parser; the columns are those of ``scan_delimited``.
    """
    names = final_names(columns) if columns else [f"_c{i}" for i in range(width or 1)]
    blocks = files.select("file_path").mapInPandas(_blocks, "file_path string, start bigint")
    lines = blocks.repartition("file_path", "start").mapInArrow(_block_rows(has_header), "file_path string, start bigint, row bigint, line string")
    cells = F.from_csv("line", F.lit(", ".join(f"c{i} string" for i in range(len(names)))), {"sep": sep})
    return lines.withColumn("_v", cells).select(
        *[F.col(f"_v.c{i}").alias(n) for i, n in enumerate(names) if n is not None],
        F.col("file_path").alias("_file_path"), F.col("start").alias("_block_start"), F.col("row").alias("_row_id"))


def number_lines(rows: DataFrame, has_header: bool, name: str = "src_row_number") -> DataFrame:
    """Add the 1-based line number within the source file; a header counts as line one, blank lines do not count.

    Each block of a file gets its base from a running sum over the file's blocks, so a large file
    stays spread over many tasks. Only the count and the first id of every block are checkpointed; the rows are read
    again, in the same blocks, since the files and the split size are the same.
    """
    blocks = stable(rows.groupBy("_file_path", "_block_start").agg(F.count(F.lit(1)).alias("_len"), F.min("_row_id").alias("_first")))
    before = Window.partitionBy("_file_path").orderBy("_block_start").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.withColumn("_base", F.coalesce(F.sum("_len").over(before), F.lit(0)) - F.col("_first")).drop("_len", "_first")
    return rows.join(bases, ["_file_path", "_block_start"]).withColumn(
        name, F.col("_base") + F.col("_row_id") + (2 if has_header else 1)).drop("_base")


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns as text, absent ones as NULL."""
    have = set(df.columns)
    return df.select(*[(col_q(c) if c in have else F.lit(None)).cast("string").alias(c) for c in columns],
                     *[c for c in META if c in have])


def schema_seeds(files: DataFrame, sep: str) -> DataFrame:
    """``(file_path, columns, error)`` of seed files: the names of each one's header line, without byte order mark and blanks.

    Only first lines are read, by tasks; a file that cannot be read has its error and no columns.
    """
    line = strip(F.ltrim(F.coalesce("first_line", F.lit("")), F.lit("\ufeff")))
    heads = files.select("file_path").mapInPandas(_heads, "file_path string, first_line string, error string")
    return heads.select("file_path", F.when(F.col("error").isNull(), split_header(line, sep)).alias("columns"), "error")


def read_schema_seed(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names from a seed file: one header line, UTF-8 with or without byte order mark."""
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True).select(
            strip(F.ltrim(F.col("value"), F.lit("\ufeff"))).alias("t")).select(F.substring_index(F.replace(F.col("t"), F.lit("\r"), F.lit("\n")), "\n", 1).alias("h")).first()
    except AnalysisException as exc:
        raise FileNotFoundError(f"Schema seed file not found: {path}") from exc
    line = text["h"] if text else ""
    return [c.strip() for c in line.split(sep)] if line.strip() else []
