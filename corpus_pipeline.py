"""A corpus pipeline in five stages, each one of the corpus operators.

quality rules -> line dedup -> near duplicates -> personal data -> packing.  Every stage takes
(spark, docs, sf_dir), works on all its predecessor kept, and returns a DataFrame; all but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brisa.llm import jaccard, line_dedup, packing, pii, quality_rules
from brisa.llm.common import documents, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and lines that too many documents of a host hold."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines inside repeated three-line windows go, and documents that keep no word for it."""
    kept = line_dedup.line_dedup(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return kept.where(~emptied).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to the name of their kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their places in windows."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("packing", packed),
]

#: Trained models and a tokenizer take part, which SQL cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each one's result written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage-" + name.replace(" ", "-").lower())
    return docs
