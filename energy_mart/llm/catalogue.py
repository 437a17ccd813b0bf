"""Name -> query, and name -> SQL with the same rows, of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from energy_mart.llm import queries as q
from energy_mart.llm.oracle import SQL

QUERIES = [
    q.op1_line_dedup, q.op2_license_scan, q.op3_toxicity, q.op4_quality_rules, q.op5_source_mix,
    q.op6_cross_polytope, q.op7_url_graph, q.op8_secret_scan, q.op9_packing, q.op10_ngram_jaccard_join,
    q.op11_collocations, q.op12_chat_windows, q.op13_spelling_variants,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
