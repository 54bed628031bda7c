"""From documents to training sequences: five of the text operators in a row.

Each stage reads all that its predecessor kept; all but the last return the columns of
``documents``. Stages are joined by written Parquet tables, so a lost executor costs the tasks it
ran and no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (
    best_fit_packing,
    decontamination,
    jaccard_join,
    line_dedup,
    quality_rules,
)
from starloom.llm.common import read_table, show_library, written

TOKENIZER = "word_bpe_49k.json"

# Sequences hold token ids of a tokenizer, which SQL can't express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the cutoffs learned from ``labels``."""
    return quality_rules.keep_good_documents(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    show_library(spark)
    return line_dedup.drop_frequent_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of similar ones."""
    show_library(spark)
    return jaccard_join.keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    show_library(spark)
    return best_fit_packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage_{i}")
    return docs
