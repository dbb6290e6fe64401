"""The corpus pipeline: filters, deduplicates and packs documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.llm import line_dedup, ngram_join, packing, quality
from haulmart.llm.queries import vocabulary
from haulmart.sources.workspace import Workspace

# No SQL can express the stages; tests/llm holds each stage's operator against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep, all columns as they are.

    A null or empty text has too few words and goes; equal rows share their fate; null
    languages and sources are groups of their own; an empty table stays empty.
    """
    return quality.kept_documents(docs)


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the lines that repeat an earlier one, ``n_chars`` counted anew; no row goes.

    Lines come in the order of ids, null first; equal rows lose the same lines; a null
    text becomes an empty one; an empty table stays empty.
    """
    clean = line_dedup.without_repeats(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of similar documents, all columns as they are.

    Rows without words are similar to none and stay. Equal rows are one group, but rows
    that share the id that stays all stay. An empty table stays empty.
    """
    return ngram_join.one_of_each_group(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its sequence and place there, and its ids.

    A null or empty text is its end id alone; rows with equal or null ids are packed each
    on its own; an empty table gives no rows.
    """
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_repeats),
    ("n-gram Jaccard join", one_of_each_group),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input."""
    place = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = place.materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
