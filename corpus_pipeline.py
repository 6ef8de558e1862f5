"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's documents.  Stages 1 to 4 return the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import decontamination, neardup, packing, quality, substring
from lodestar.llm.queries import _tokenizer
from lodestar.llm.shared import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return neardup.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; words of repeats of 13 words or more that an earlier document holds are cut from the text."""
    cut = substring.cut_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    return packing.pack(docs, _tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Tokenisation and MinHash components have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
