"""Puts the given tables into files, so that the readers have something of the tables' size to read."""
from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedyard.checks import views as v
from feedyard.session import work_dir
from feedyard.sources.remote import write_bytes

PER_FILE = 50
FEED_REGEX = r"^customers_(\d+)(?:_(v\d+))?\.(txt|zip)$"
FEED_SPEC = "1|vendor_code|string;2|file_version_label|string;3|file_extension|string"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer lines in files of fifty keys, with one of three headers per file."""
    c = v.table(spark, sf_dir, "customer")
    chunk = F.floor(F.col("c_custkey") / PER_FILE)
    kind = F.pmod(chunk, F.lit(3))
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    line = (F.when(kind == 0, F.concat_ws("|", key, "c_name", nation, "c_mktsegment"))
            .when(kind == 1, F.concat_ws("|", key, F.concat(F.lit('"'), "c_mktsegment", F.lit('|x"')), "c_name"))
            .otherwise(F.concat_ws("|", key, "c_name", nation, F.concat(F.lit("e"), nation))))
    header = F.when(kind == 0, "custkey|name|nation|segment").when(kind == 1, "custkey|segment|name").otherwise(" custkey | name|nation|d.e")
    return c.select("c_custkey", chunk.alias("chunk"), line.alias("line"), header.alias("header"))


# Of three files one begins as usual, one with an underscore and one with a dot.
PREFIXES = ("", "_", ".")
ANY_REGEX = FEED_REGEX.replace("^", "^[_.]?")


def spoil(data: bytes, how: int) -> bytes:
    """An archive with bytes of its first member gone (1), or with all members marked as encrypted (2)."""
    out = bytearray(data)
    if how == 1:
        at = data.find(b"PK\x01\x02") // 2
        out[at:at + 40] = bytes(40)
    if how == 2:
        for mark, flag in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
            at = data.find(mark)
            while at >= 0:
                out[at + flag] |= 1
                at = data.find(mark, at + 1)
    return bytes(out)


def write(rows: DataFrame, folder: str, zipped: bool = False, prefixed: bool = False, spoilt: bool = False) -> None:
    """One file per chunk; each is written by one task and holds at most fifty lines. With ``spoilt`` two archives of five are bad."""
    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c_custkey")
        chunk = int(pdf["chunk"].iloc[0])
        text = "\n".join([pdf["header"].iloc[0], *pdf["line"]]) + "\n"
        if zipped:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"inner/m_{chunk}.TXT", text)
                z.writestr("inner/readme.csv", "not,read\n")
            data, name = spoil(buffer.getvalue(), chunk % 5 if spoilt else 0), f"customers_{chunk}.zip"
        else:
            data, name = text.encode(), f"customers_{chunk}.txt"
        write_bytes(f"{folder}/{PREFIXES[chunk // 3 % 3] if prefixed else ''}{name}", data)
        return pd.DataFrame({"n": [len(data)]})

    rows.groupBy("chunk").applyInPandas(put, "n bigint").agg(F.sum("n")).collect()


def dropped(spark: SparkSession, sf_dir: str, zipped: bool = False, prefixed: bool = False, spoilt: bool = False) -> str:
    folder = work_dir(spark, "drop")
    write(customers(spark, sf_dir), folder, zipped, prefixed, spoilt)
    return folder
