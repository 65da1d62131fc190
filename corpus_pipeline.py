"""The corpus pipeline: classify, drop near-duplicates, decontaminate, mix, write ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept; the classifier learns from the labels under ``sf_dir`` and those of the
documents it is given, decontamination searches for the items of ``benchmark``.
A stage handles nulls, repeated rows, empty tables and extra columns as its
operator's docstring says; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, mixing, simhash, subword, tokenout
from strata.llm.common import DOCUMENT_COLUMNS, shared_path, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier accepts; those it rejects go."""
    return subword.accepted(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: 4-word shingles, at most 4 bits apart."""
    return simhash.first_of_each(docs.select(*DOCUMENT_COLUMNS))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.clean(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each whole pass over a document, one for the words its last pass takes."""
    return mixing.mixed_documents(docs.select(*DOCUMENT_COLUMNS))


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the blocks written and read back."""
    return tokenout.write_and_read(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_first_copies),
    ("benchmark decontamination", keep_clean),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_ids),
]

#: SQL can express neither the trained classifier nor the stages after it; the
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    root = shared_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
