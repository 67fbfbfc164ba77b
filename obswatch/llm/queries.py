"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obswatch.llm import classifier, flac, language, maxent, neardup, packing, pieces, rules, sharding, warc


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": neardup.op1_ngram_jaccard_join,
    "op2_quality_rules": rules.op2_quality_rules,
    "op3_sharding": sharding.op3_sharding,
    "op4_packing": packing.op4_packing,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_warc": warc.op6_warc,
    "op7_quality_classifier": classifier.op7_quality_classifier,
    "op8_lm_scoring": maxent.op8_lm_scoring,
    "op9_language_id": language.op9_language_id,
    "op10_media_columns": flac.op10_media_columns,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {"op3_sharding": sharding.OP3_SQL, "op6_warc": warc.OP6_SQL}
