"""Quality classifier: ridge regression on random Fourier features, with isotonic calibration.

The statistics of a text (textstats.FEATURES) are standardised and mapped by cosines of seeded random
projections, whose inner products approximate a Gaussian kernel. The normal equations are sums over the
labelled rows: each task adds its rows' outer products, Spark adds the tasks' entries, and the driver
solves one system of fixed size. Rows kept apart from the regression calibrate its values: their mean
labels by value, in bins of equal width, are pooled into the closest rising steps (isotonic regression),
which are joined by straight lines.

Defined results: a null text is an empty one and gets the score of its statistics (zeros); of several
labels of a document the best counts; repeated rows get equal scores; without labels every score is 0.5.
Input columns named as an output are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obswatch.llm import textstats
from obswatch.llm.common import append_columns, id_hash, table, written

DIM, BINS, RIDGE, SEED = 192, 512, 1e-4, 20240607


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    steps: tuple[np.ndarray, np.ndarray]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with stats, the statistics of the text."""
    return append_columns(docs, text, [("stats", T.ArrayType(T.DoubleType()))], lambda: lambda texts: [[textstats.features(t)[1] for t in texts]])


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The random features of rows of statistics, and a constant."""
    draw = np.random.default_rng(SEED)
    w, b = draw.normal(size=(stats.shape[1], DIM)) / np.sqrt(stats.shape[1] / 2), draw.uniform(0, 2 * np.pi, DIM)
    z = np.clip((stats - mean) / scale, -8, 8)
    return np.hstack([np.cos(z @ w + b) * np.sqrt(2 / DIM), np.ones((len(z), 1))])


def rising(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y, weighted by n, at rising x: middles and heights of the pooled steps."""
    blocks: list[list[float]] = []  # sum of y, of x, weight
    for a, b, c in zip(x, y, n, strict=True):
        blocks.append([b * c, a * c, c])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][2] >= blocks[-1][0] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top, strict=True)]
    got = np.array(blocks)
    return got[:, 1] / got[:, 2], got[:, 0] / got[:, 2]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def train(labelled: DataFrame, calibrate) -> Model:
    """From a written frame with stats and quality; calibrate marks the rows kept for calibration."""
    width = len(textstats.FEATURES)
    fit = labelled.where(~calibrate)
    s = [F.col("stats")[i] for i in range(width)]
    row = fit.agg(F.count("*"), *(F.avg(c) for c in s), *(F.stddev_pop(c) for c in s)).first()
    if not row[0]:
        return Model(np.zeros(width), np.ones(width), None, (np.zeros(1), np.full(1, 0.5)))
    mean, scale = np.array(row[1 : 1 + width]), np.array(row[1 + width :])
    scale = np.where(scale > 1e-9, scale, 1.0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DIM + 1, DIM + 2))
        for b in batches:
            x = fourier(_matrix(b.column(0), width), mean, scale)
            total += x.T @ np.hstack([x, b.column(1).to_numpy(zero_copy_only=False).astype(float)[:, None]])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    sums = fit.select("stats", "quality").mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    full = np.zeros((DIM + 1, DIM + 2))
    full[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["v"].to_numpy()
    weights = np.linalg.solve(full[:, :-1] + RIDGE * row[0] * np.diag([1.0] * DIM + [1e-6]), full[:, -1])
    first = Model(mean, scale, weights, (np.zeros(1), np.zeros(1)))
    values = _scored(labelled.where(calibrate).select("stats", "quality"), first, raw=True)
    at = F.floor((F.greatest(F.lit(-0.5), F.least(F.lit(1.5), F.col("score"))) + 0.5) * (BINS / 2))
    bins = values.groupBy(at.alias("bin")).agg(F.avg("score").alias("x"), F.avg("quality").alias("y"), F.count("*").alias("n")).orderBy("x").toPandas()
    if not len(bins):
        return Model(mean, scale, weights, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    return Model(mean, scale, weights, rising(bins["x"].to_numpy(float), bins["y"].to_numpy(float), bins["n"].to_numpy(float)))


def _scored(rows: DataFrame, model: Model, raw: bool = False) -> DataFrame:
    """rows with score from stats; raw: the regression's value, else calibrated."""
    width = len(textstats.FEATURES)
    rows = rows.drop("score")
    names = [*rows.columns, "score"]
    at = rows.columns.index("stats")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model.weights is None:
                values = np.full(b.num_rows, 0.5)
            else:
                values = fourier(_matrix(b.column(at), width), model.mean, model.scale) @ model.weights
                if not raw:
                    values = np.clip(np.interp(values, *model.steps), 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values)], names=names)

    return rows.mapInArrow(task, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))


def classify(measured: DataFrame, model: Model, cutoff: float = 0.3) -> DataFrame:
    """measured with score, from 0 to 1, and predicted."""
    return _scored(measured, model).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def labelled(measured: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The measured rows that have a label; narrow rows meet, not texts."""
    best = labels.where(F.col("quality").isNotNull()).groupBy(key).agg(F.max("quality").alias("quality"))
    return written(measured.join(best, key).select(key, "stats", "quality"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels outside the fifth that is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = written(measure(docs).drop("text"))
    rest = id_hash(F.col("doc_id"))
    rows = labelled(measured, table(spark, sf_dir, "labels")).where(rest % 5 != 0)
    model = train(rows, id_hash(F.col("doc_id")) % 4 == 1)
    return classify(measured, model).select("doc_id", (rest % 5 == 0).alias("held_out"), "score", "predicted")
