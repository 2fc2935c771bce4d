"""A training corpus in five stages: toxic documents out, exact copies out, near copies out, contaminated documents out, then tokens."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedyard.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from feedyard.llm.common import read_table
from feedyard.llm.queries import TOKENIZER, fold
from feedyard.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rates below the threshold; it learns from the labels outside the held-out fold."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"), ~fold(3, 1))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact_dedup.drop_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies."""
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the tokens of each document."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("bpe", to_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None  # a trained network decides in the first stage
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
