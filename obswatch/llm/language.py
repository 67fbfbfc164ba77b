"""Language identification by mixture inference.

Every language has a distribution over hashed character trigrams, counted over all labelled training
documents. A text is taken as words, each written in one language; expectation-maximisation finds the
shares of the languages among its words, and nested sets of languages, the likeliest first, are compared by
likelihood with a penalty per language: a text's set grows until another language no longer pays, up to all
of them. The language with the largest share in the chosen set is the prediction.

Defined results: a null text or one without a letter gets ``und`` with score 0 and no languages; ties
between languages go to the first in code order; without any labelled row every text is ``und``.
Repeated rows are scored alike. Input columns named as an output are replaced, others are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obswatch.llm.common import apart, append_columns, id_hash, runs, ship, table

BITS = 15
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: log probability by bucket and language, float32; 128 KB a language at 15 bits.
    table: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter, the word it is in, and the text of every word.

    Words here are maximal runs of letters; the characters around them count as a blank.
    """
    joined = "\n".join((t or "").lower().replace("\n", " ") for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    line = code == 10
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(32))
    wide = np.concatenate([[32], code, [32]]).astype(np.uint32)
    h = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    bucket = (h >> np.uint32(32 - BITS))[letter].astype(np.int32)
    start = letter & ~np.concatenate([[False], letter[:-1]]) if len(letter) else letter
    word = (np.cumsum(start) - 1)[letter]
    doc = np.cumsum(line)[start]
    return bucket, word, doc


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts trigrams over all rows with a language; rows with a null language are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for a, b in runs(texts):
                bucket, word, doc = trigrams(texts[a:b])
                of = langs[a:b][doc[word]] if len(word) else np.array([], object)
                names, index = np.unique(langs[a:b].astype(str), return_inverse=True)
                both = np.bincount(index[doc[word]] * (1 << BITS) + bucket, minlength=len(names) << BITS).reshape(len(names), -1) if len(of) else np.zeros((len(names), 1 << BITS), np.int64)
                for name, row in zip(names, both, strict=True):
                    totals[str(name)] = totals.get(str(name), 0) + row
        for name, row in sorted(totals.items()):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())], names=["lang", "bucket", "n"])

    counted = docs.where(F.col(lang).isNotNull()).select(text, lang).mapInArrow(task, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # at most 2^15 rows a language, whatever the input
    names = np.array(got["lang"].to_pylist(), object)
    languages = sorted(set(names))
    counts = np.zeros((1 << BITS, len(languages)), np.float64)
    counts[got["bucket"].to_numpy(), np.searchsorted(languages, names) if languages else []] = got["n"].to_numpy()
    smooth = counts + 0.5
    return Model(languages, np.log(smooth / smooth.sum(0)).astype(np.float32) if languages else np.zeros((1 << BITS, 0), np.float32))


def infer(model: Model, texts: list[str | None], rounds: int = 12, penalty: float = 3.0, temper: float = 0.5) -> tuple[list, list, list, list]:
    """Prediction, score, the chosen set of languages and its shares, for each text.

    temper: weight of a trigram's log likelihood, as trigrams that overlap aren't independent.
    penalty: log likelihood that another language must bring, times the log of the number of words.
    """
    size, k = len(texts), len(model.languages)
    none = ([UNDETERMINED] * size, [0.0] * size, [[] for _ in range(size)], [[] for _ in range(size)])
    bucket, word, doc = trigrams(texts)
    if not k or not len(word):
        return none
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    like = np.add.reduceat(model.table[bucket], first, axis=0) * temper
    like = np.ascontiguousarray(like.T, np.float64)  # languages x words
    like = np.exp(np.maximum(like - like.max(0), -60))
    words = np.bincount(doc, minlength=size)
    has = np.flatnonzero(words)
    at = np.concatenate([[0], np.cumsum(words[has])[:-1]])
    row = np.repeat(np.arange(len(has)), words[has])
    n = words[has].astype(np.float64)

    def fit(allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share = allowed / allowed.sum(0)
        for _ in range(rounds):
            part = np.take(share, row, axis=1)
            part *= like
            part /= part.sum(0) + 1e-300
            share = np.add.reduceat(part, at, axis=1) / n
        return share, np.add.reduceat(np.log((np.take(share, row, axis=1) * like).sum(0) + 1e-300), at)

    full, _ = fit(np.ones((k, len(has))))
    order = np.argsort(-full, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(k)[:, None], axis=0)
    share = np.zeros((k, len(has)))
    np.put_along_axis(share, order[:1], 1.0, axis=0)
    best, value = share, np.add.reduceat(np.log(like[order[0, row], np.arange(len(row))] + 1e-300), at)
    growing = np.ones(len(has), bool)
    for m in range(2, k + 1):
        share, fits = fit((rank < np.where(growing, m, 1)).astype(float))
        worth = fits - penalty * (m - 1) * np.log(n + 1)
        growing &= worth > value
        if not growing.any():
            break
        best, value = np.where(growing, share, best), np.where(growing, worth, value)
    out = none
    for i, d in enumerate(has):
        shares = best[:, i]
        lead = int(np.argmax(shares))
        out[0][d], out[1][d] = model.languages[lead], float(min(1.0, shares[lead]))
        chosen = [j for j in np.argsort(-shares, kind="stable") if shares[j] > 1e-3]
        out[2][d], out[3][d] = [model.languages[j] for j in chosen], [float(shares[j]) for j in chosen]
    return out


def detect(docs: DataFrame, model: Model, text: str = "text", **settings) -> DataFrame:
    """docs with lang_pred, score, languages and shares."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 128 KB a language, however many documents
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("languages", T.ArrayType(T.StringType())), ("shares", T.ArrayType(T.DoubleType()))]
    return append_columns(docs, text, fields, lambda: lambda texts: list(infer(held.value, texts, **settings)))


def held_out(doc_id) -> object:
    return id_hash(doc_id) % 4 == 2


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score, languages, shares."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return detect(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model).drop("text")


#: Scores are compared with labels in steps of this width.
STEP = 0.05


def cutoff(found: DataFrame, lang: str = "lang") -> float:
    """The highest step of the score below which predictions of labelled documents are wrong more often than right."""
    judged = found.where(F.col(lang).isNotNull() & (F.col("lang_pred") != UNDETERMINED))
    steps = judged.groupBy(F.floor(F.col("score") / STEP + 1e-9).alias("step")).agg(F.count("*").alias("n"), F.count_if(F.col(lang) != F.col("lang_pred")).alias("bad")).orderBy("step").collect()  # 21 rows at most
    n = bad = 0
    out = 0.0
    for r in steps:
        n, bad = n + r["n"], bad + r["bad"]
        if 2 * bad > n:
            out = (r["step"] + 1) * STEP
    return out


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: those without a letter, and those whose score lies below the
    cutoff that the errors on held-out labelled documents set (documents mostly in two languages at once).

    The model is learned from documents that aren't held out. Null and empty texts go; without any labelled
    document nothing is known of languages, and all with a letter stay; repeated rows are judged alike; an
    empty table stays empty; columns of any name pass through unchanged, also those that an output is named as.
    """
    ship(spark)
    renamed, back = apart(docs, ["lang_pred", "score", "languages", "shares"])
    model = train(renamed.where(~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = detect(renamed, model)
    least = cutoff(found.where(held_out(F.col("doc_id"))))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select(*back)
