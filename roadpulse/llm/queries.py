"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import lexical_search, license_scan, line_dedup, merkle, oracles
from .chat_format import format_chats, read_back
from .common import ship_package, table
from .mixing import mix_sources
from .ngram_join import ngram_jaccard_join
from .quality_rules import judge_quality
from .secret_scan import secret_report
from .sentence_pieces import encode_report
from .token_count import token_counts
from .url_filter import judge_urls
from .vector_search import nearest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

CHAT_PROBE = "</s>[INST] ok [/INST]"


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_report(table(spark, sf_dir, "documents"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-1, 0, "user", CHAT_PROBE), (-1, 1, "assistant", CHAT_PROBE)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return read_back(format_chats(turns), sorted_by_seq=True)


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), budget=1024)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents")).drop("text_hash")
    return judged.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


ORACLE |= {
    "op2_license_scan": license_scan.oracle_sql(),
    "op4_mix_sources": oracles.mixture(),
    "op5_chat_format": oracles.chats(CHAT_PROBE),
    "op6_url_filter": oracles.urls(),
    "op8_quality_rules": oracles.quality(),
    "op10_ngram_jaccard": oracles.jaccard(),
    "op11_line_dedup": line_dedup.oracle_sql(),
    "op12_merkle_manifest": merkle.oracle_sql(),
    "op13_lexical_search": lexical_search.oracle_sql(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
