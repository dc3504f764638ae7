"""The registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm import (
    collocations,
    decontamination,
    language_id,
    oracle,
    packing,
    quality_rules,
    ranked_search,
    rp_forest,
    secret_scan,
    simhash,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from plexus.llm.common import table
from plexus.session import scratch_path

URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop(*quality_rules.RULES)


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, word_tokenizer(), end_id=1)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), end_id=2).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda i: ~toxicity.held_out(i))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.PREDICT, 1).otherwise(0).alias("predicted"), "spans")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, lambda i: ~language_id.held_out(i))
    return language_id.label(docs, model).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def benchmark_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, share=100, top=2000)


def lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_url_filters": url_filters,
    "op2_toxicity": toxic,
    "op3_token_ids": token_ids,
    "op4_language_id": languages,
    "op5_packing": packed,
    "op6_token_counts": counted,
    "op7_simhash_near_dedup": near_duplicates,
    "op8_decontamination": benchmark_copies,
    "op9_secret_scans": secrets,
    "op10_quality_rules": quality,
    "op11_nearest_neighbours": neighbours,
    "op12_collocations": phrases,
    "op13_ranked_search": lexical,
}

# The other operators hash with XXH64, align, train or call a tokenizer, which SQL
# cannot state; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": oracle.url_sql(URL_RULES),
    "op10_quality_rules": oracle.quality_sql(),
    "op12_collocations": oracle.collocations_sql(least=100, top=2000, order=collocations.ORDER),
    "op13_ranked_search": oracle.ranked_search_sql(k=10),
}
