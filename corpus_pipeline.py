"""A training-data run over ``documents``: each stage works on all that the one before kept.

Rejected documents go; frequent lines go from the rest; of each group of near copies (five-word shingles,
a similarity of 0.8 or more) the one with the smallest id stays; the sources are mixed to their target weights; and what is taken
is packed into windows. ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.llm import line_dedup, ngram_join, packing, quality_rules, source_mix
from energy_mart.llm.common import table
from energy_mart.session import materialise, release, settled_tables

#: Sampled shares, permutations and least squares have no SQL form; the test compares each stage.
ORACLE_SQL = None
#: (session's application, folder of the tables) -> what the latest stage over it settled on its way.
_LEFT: dict[tuple[str, str], list[DataFrame]] = {}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _after_another(stage: Stage) -> Stage:
    """The stage, beginning with the deletion of the tables that the one before settled on its way.

    Their result is settled before this stage begins, so nothing reads them any more; if ``docs`` is
    not settled and still reads them, they stay until the session ends.
    """

    @wraps(stage)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        run = (spark.sparkContext.applicationId, sf_dir)
        left = _LEFT.pop(run, []) if stage is not quality else []
        files = docs.inputFiles() if left else []
        if not any(f"/{t._settled_in.rsplit('/', 1)[1]}/" in file for t in left for file in files):
            for t in left:
                release(t)
        with settled_tables() as made:
            out = stage(spark, docs, sf_dir)
        _LEFT[run] = made
        return out

    return staged


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with the given columns and ``n_chars`` of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.dedup(docs), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Stages on word shingles take five words and a similarity of 0.8.
    return ngram_join.one_of_each(docs, 5, 80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(source_mix.mix(docs), docs.columns)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    (name, _after_another(stage))
    for name, stage in (
        ("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies),
        ("source mix", mixture), ("packing", windows),
    )
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of ``packing`` for all of ``documents``; every stage is settled before the next."""
    docs, settled = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        after = materialise(stage(spark, docs, sf_dir))
        if settled is not None:
            release(settled)
        docs = settled = after
    return STAGES[-1][1](spark, docs, sf_dir)
