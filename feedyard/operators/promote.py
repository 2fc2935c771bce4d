"""From bronze text to typed silver rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedyard.functions.fingerprints import packed, unpacked
from feedyard.functions.text import col_q


def legit_files(inventory: DataFrame) -> DataFrame:
    return inventory.filter("flg_legit_for_silver = 'Y'").select(F.col("file_fingerprint").alias("src_file_fingerprint"))


def to_silver(bronze: DataFrame, inventory: DataFrame, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Rows of promoted files with columns renamed and cast.

    ``mapping`` is ``(bronze column, silver column, type)``; text that does not cast becomes NULL.
    The fingerprint stays, so every silver row leads back to its file; it travels packed.
    """
    cells = [col_q(a).try_cast(kind).alias(b) for a, b, kind in mapping]
    legit = legit_files(inventory).select(packed(F.col("src_file_fingerprint"), b"\x03").alias("_print"))
    rows = bronze.withColumn("_print", packed(F.col("src_file_fingerprint"))).drop("src_file_fingerprint").join(legit, "_print", "left_semi")
    return rows.withColumn("src_file_fingerprint", unpacked(F.col("_print"))).select("src_file_fingerprint", *cells)
