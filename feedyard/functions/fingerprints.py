"""File identity."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedyard.functions.paths import fingerprint_path


def file_fingerprint(path: Column, size: Column, mtime_ms: Column) -> Column:
    """Lower-case hex SHA-256 of ``path|size|mtime``; a missing number is the word ``none``."""
    def number(c: Column) -> Column:
        return F.coalesce(c.cast("bigint").cast("string"), F.lit("none"))

    return F.sha2(F.concat_ws("|", fingerprint_path(path), number(size), number(mtime_ms)), 256)


def is_digest(text: Column) -> Column:
    """Whether a text is 64 lower-case hex digits; false for NULL."""
    return F.coalesce(text.rlike(r"^[0-9a-f]{64}\z"), F.lit(False))


def packed(text: Column, null: bytes = b"\x02") -> Column:
    """Text as binary for shuffles: a digest takes 33 bytes, other text one byte more than before.

    The first byte says which, so different texts stay different; :func:`unpacked` gives the text back. NULL becomes ``null``, which begins
    with a byte above 1: sides of a join that give it differently do not match there, and need no filter that would compute texts once more.
    """
    binary = F.when(is_digest(text), F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))
    return F.coalesce(binary, F.lit(null))


def unpacked(data: Column) -> Column:
    kind, rest = F.substring(data, 1, 1), F.substring(data, 2, 2 ** 31 - 1)
    return F.when(kind == F.lit(b"\x01"), F.lower(F.hex(rest))).when(kind == F.lit(b"\x00"), rest.cast("string"))


def enrich_listing(listing: DataFrame) -> DataFrame:
    """Add typed size, modification time and fingerprint to listing rows.

    ``size`` falls back to ``file_size``; text that is no number becomes NULL.
    """
    raw = F.col("size").cast("string")
    if "file_size" in listing.columns:
        raw = F.coalesce(raw, F.col("file_size").cast("string"))
    size = raw.try_cast("bigint")
    mtime = F.col("modificationTime").cast("string").try_cast("bigint")
    return listing.withColumns({
        "file_size": size,
        "src_size": size,
        "src_mtime_ms": mtime,
        "file_fingerprint": file_fingerprint(F.coalesce(F.col("file_path"), F.lit("")), size, mtime),
    })
