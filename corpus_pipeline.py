"""The corpus pipeline: quality, near copies, repeated passages, private data, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from packetloom.llm.byte_convnet import keep_good
from packetloom.llm.components import shared_folder
from packetloom.llm.jaccard_join import keep_one
from packetloom.llm.packing import pack
from packetloom.llm.pseudonyms import pseudonymised
from packetloom.llm.queries import PSEUDONYM_KEY, table, vocabulary
from packetloom.llm.substring_dedup import without_passages

#: Near copies share so many hundredths of their runs of so many words; op8's own defaults are another choice.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, NEAR_PERCENT, NEAR_WORDS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_passages(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonymised(docs, PSEUDONYM_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeated_passages", repeated_passages),
          ("private_data", private_data), ("packing", packing)]
ORACLE_SQL = None  # no stage is expressible in SQL; tests/llm compare each with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on all that the one before kept, written as Parquet in between."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def stored(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """Written in the folder that ``spark.checkpoint.dir`` names, and read again; each run has its own place."""
    path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
    docs.write.parquet(path)
    return spark.read.parquet(path)
