"""The training-data operators on the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.llm import (
    chat_windows, collocations, cross_polytope, license_scan, line_dedup, ngram_join, packing, quality_rules, secret_scan,
    source_mix, spelling, toxicity, url_graph,
)
from energy_mart.llm.common import settle, table
from energy_mart.session import literal_rows

#: Fixed value: a conversation whose texts hold the template's own marks.
MARKED = r"\### Assistant: </turn> ok"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    measured = settle(quality_rules.measure(docs).drop("text"))
    return quality_rules.judge(measured).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.taken_words(table(spark, sf_dir, "documents"))


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cross_polytope.usable(table(spark, sf_dir, "embeddings"))
    return cross_polytope.nearest(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op7_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = literal_rows(spark, [(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    return chat_windows.digest(settle(chat_windows.windows(given.unionByName(marked))))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(settle(spelling.vocabulary(table(spark, sf_dir, "documents"))))
