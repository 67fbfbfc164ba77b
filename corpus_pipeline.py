"""Corpus preparation: the documents whose language and quality are accepted, one of each group of near
copies, packed into training sequences. Each stage's result is written as Parquet and read by the next, and
dropped when that one is written.

Defined results: null and empty texts, and those without a letter, go with the first stage; of repeated rows one
stays (third stage); very long texts are read whole; an empty table gives no sequences; columns of any name,
also those that a stage's output is named as, pass through unchanged as far as packing, whose rows are pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obswatch.llm import language, neardup, packing, rules
from obswatch.llm.common import drop_written, table, written

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language.stage),
    ("quality_rules", rules.stage),
    ("ngram_jaccard_join", neardup.stage),
    ("packing", packing.stage),
]

#: No stage can be put in SQL; tests hold each against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            drop_written(before)
        before = docs
    return docs
