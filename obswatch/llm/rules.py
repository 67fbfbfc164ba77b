"""Quality rules with risk-controlled thresholds.

A document fails the base when it has under 20 words, or when over 30 % of its words lie in repeated
8-word windows. The others are judged by rules, each of which rejects values above a cutoff. Cutoffs
are set per stratum. One half of the labelled good texts (by a hash of the text) gives, for each of a
ladder of levels, the cutoffs that so large a share of it exceeds under each rule. The other half tests
each level: the rules together may reject a good text with probability ``risk`` at most, shown by the
exact (Clopper-Pearson) upper bound for the rejections counted there, at confidence ``1 - delta`` shared
over all levels and strata (Bonferroni), so that the bound holds for whichever of the levels that pass is
used: that which rejects most of the labelled bad texts, of equals the one that rejects least. A stratum
without one, such as one with few labels, rejects nothing beyond the base.

A trial is a distinct text of a stratum: copies and repeated ids are one trial, as they aren't independent.

Defined results: a null text has no words and fails the base; a null stratum is a stratum of its own, which
no name is mixed up with; of several labels of one text the best counts; repeated rows are judged alike;
with no labels only the base rejects; an empty table gives no rows. Input columns named as an output are
replaced by the operator and passed through by the stage.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obswatch.llm import textstats
from obswatch.llm.common import apart, append_columns, ship, table, written

#: A rule rejects high values of one of these.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "same_next_share", "bar_share", "bang_share", "digit_share", "word_length")
#: Shares of good texts that a rule may exceed, a ladder in steps of about the root of ten.
LEVELS = (0.03, 0.01, 0.003, 0.001, 0.0003, 0.0001)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def upper_bound(k: int, n: int, delta: float) -> float:
    """The exact upper confidence bound for a share of which k of n trials were seen."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i])
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        terms = logs + i * math.log(p) + (n - i) * math.log1p(-p) if p < 1 else np.array([-np.inf])
        top = terms.max()
        if top + math.log(np.exp(terms - top).sum()) > math.log(delta):
            low = p
        else:
            high = p
    return high


def _values(texts: list[str | None]) -> list[list]:
    at = [textstats.FEATURES.index(r) for r in RULES]
    counts, values = zip(*((c, [v[i] for i in at]) for c, v in map(textstats.features, texts)), strict=True)
    return [*(list(c) for c in zip(*counts, strict=True)), list(values)]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts, base_failed and rule_values."""
    fields = [(c, T.LongType()) for c in COUNTS] + [("rule_values", T.ArrayType(T.DoubleType()))]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = append_columns(docs, text, fields, lambda: _values).withColumn("base_failed", failed)
    return measured.withColumn("text_key", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _exceeds(cutoffs: Column) -> Column:
    return F.exists(F.zip_with("rule_values", cutoffs, lambda v, c: v > c), lambda x: x)


def cutoffs(measured: DataFrame, labels: DataFrame, key: str, stratum: Column, risk: float, delta: float) -> dict[str, list[float]]:
    """The tested cutoffs of each stratum that has some; strata are a closed set, such as languages."""
    best = labels.where(F.col("quality").isNotNull()).groupBy(key).agg((F.max("quality") >= 1).alias("good"))
    each = measured.where(~F.col("base_failed")).select(key, stratum.alias("stratum"), "text_key", "rule_values").join(best, key)
    rows = each.groupBy("stratum", "text_key").agg(F.bool_or("good").alias("good"), F.first("rule_values").alias("rule_values")).withColumn("test", F.crc32(F.col("text_key").cast("binary")) % 2 == 0)
    rows = written(rows)
    asked = [1 - x for x in LEVELS]
    found = rows.where("good and not test").groupBy("stratum").agg(*(F.percentile_approx(F.col("rule_values")[i], asked, 20000).alias(f"r{i}") for i in range(len(RULES)))).collect()
    by = {r["stratum"]: [[r[f"r{i}"][j] for i in range(len(RULES))] for j in range(len(LEVELS))] for r in found}
    if not by:
        return {}
    held = rows.sparkSession.createDataFrame([(s, j, c) for s, levels in by.items() for j, c in enumerate(levels)], "stratum string, level int, cutoffs array<double>")
    over, good = _exceeds(F.col("cutoffs")), F.col("good")
    seen = rows.join(F.broadcast(held), "stratum").groupBy("stratum", "level").agg(F.count_if(good & F.col("test")).alias("n"), F.count_if(good & F.col("test") & over).alias("k"), F.count_if(~good & over).alias("bad")).collect()
    share = delta / (len(by) * len(LEVELS))
    passed: dict[str, tuple[int, int]] = {}
    for r in seen:
        if r["n"] and upper_bound(r["k"], r["n"], share) <= risk:
            passed[r["stratum"]] = max((r["bad"], r["level"]), passed.get(r["stratum"], (-1, 0)))
    return {s: by[s][j] for s, (_, j) in passed.items()}


def judge(measured: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """measured (a written frame of measure()) with kept, the verdict."""
    layer = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))  # a null is no name
    chosen = cutoffs(measured, labels, key, layer, risk, delta)
    if not chosen:
        return measured.withColumn("kept", ~F.col("base_failed")).drop("text_key")
    limits = F.create_map(*(x for s, c in sorted(chosen.items()) for x in (F.lit(s), F.array(*map(F.lit, c)))))
    return measured.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(_exceeds(limits[layer]), F.lit(False))).drop("text_key")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = written(measure(docs).drop("text"))
    return judge(measured, table(spark, sf_dir, "labels")).select("doc_id", *COUNTS, "base_failed", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or the rules reject go; null and empty texts are among them.

    Without labels only the base rejects; repeated rows are judged alike; an empty table stays empty; columns
    of any name pass through unchanged.
    """
    ship(spark)
    renamed, back = apart(docs, [*COUNTS, "rule_values", "base_failed", "kept", "text_key"])
    measured = written(measure(renamed))
    return judge(measured, table(spark, sf_dir, "labels")).where("kept").select(*back)
