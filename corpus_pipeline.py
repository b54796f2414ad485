"""A training corpus from raw documents: five stages, each a Parquet table that the next one reads.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``, extra ones included; the last places every document in training
sequences. Null and empty texts count as empty: the classifier gives them its bias, the near-copy
stage keeps one of them, packing gives them the end id alone. Null ids stay, and rows with them are never
near copies of others. Rows that repeat id and text share their fate and stay repeated. Texts are
taken whole, however long; an empty table stays empty through all stages.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents
from tessera.llm.decontam import without_contaminated
from tessera.llm.linededup import dedup_lines
from tessera.llm.nearcopies import one_of_each_near
from tessera.llm.packing import pack_documents
from tessera.llm.quality import accepted
from tessera.shared import settled


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled documents of its input."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; ``n_chars`` follows the text."""
    cut = dedup_lines(docs).drop("n_lines", "n_dropped")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that with the smallest id."""
    return one_of_each_near(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its training sequence and place there."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]
#: SQL expresses neither a trained classifier nor a tokenizer; tests hold each stage against
#: brute force on its predecessor's rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again, and what it wrote on its way goes."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settled(spark, partial(stage, spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
