"""A training-data pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``. Every stage takes nulls in any
column, empty and very long texts, ties, repeated rows, empty tables and extra
columns of any name (its docstring says what becomes of them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import cut, ship_package, table
from roadpulse.llm.mixing import mix_sources
from roadpulse.llm.ngram_join import keep_one_each
from roadpulse.llm.quality_rules import keep_good
from roadpulse.llm.secret_scan import redact
from roadpulse.llm.sentence_pieces import encode

#: Viterbi over a piece vocabulary has no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: null, empty and very short texts
    go, repeated rows stay or go together."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links, that of
    the smallest id; of repeated rows one stays, and every row without an id."""
    ship_package(spark)
    return keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked; null and empty texts stay as they are."""
    ship_package(spark)
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights and shuffled; a null
    source is a source of its own; repeated rows draw one count and are each
    repeated by it."""
    return mix_sources(docs).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text: ``doc_id``, ``n_pieces``, ``ids``; a null or
    empty text has none, a row without an id stays."""
    ship_package(spark)
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture),
          ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
