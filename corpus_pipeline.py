"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing, packing.

Each stage takes the documents its predecessor kept and returns documents, the last one the
pieces of the packed sequences. ``run`` writes each stage's rows as Parquet below the shared
folder and reads them again, so a lost executor costs part of one stage at most.

All stages take null texts, empty tables, repeated rows and further columns of any name (not
starting with two underscores); what each does with them is in its operator's docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import mixing, packing, quality, simhash, toxicity
from tickloom.llm.common import importable, table
from tickloom.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test of their language and source keep."""
    importable(spark)
    return quality.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model trained on this stage's own input."""
    importable(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scores(F.col("text"), model) < toxicity.THRESHOLD)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    importable(spark)
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents repeated or, at a source's end, cut as it takes them."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their ids."""
    importable(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# SQL expresses neither the trained stages nor the tokenizer; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
