"""Features as of a day, count regressions, scores, retraining triggers."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.functions.text import observation_id
from obswatch.operators import predicates, state


def best_by(df: DataFrame, keys: list[str], value: str, rank: Column) -> DataFrame:
    """A key's value of the highest rank; values that are null don't count, ties go to the larger value."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(F.col(value), F.struct(rank.alias("r"), F.col(value).alias("v"))).alias(value))


def newest_known(df: DataFrame, keys: list[str], values: list[str], at: str) -> DataFrame:
    """For each value column its newest value that isn't null."""
    return df.groupBy(*keys).agg(*(F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct(F.col(at), F.col(v)))).alias(v) for v in values))


def degree_sum(value: Column, threshold: float, hours: float = 24.0) -> Column:
    return hours * F.greatest(F.lit(0.0), F.lit(threshold) - value)


FEATURES = ["log_last_count", "days_since_last_count", "gauge_temp", "gauge_change_3d", "gauge_degree_hours_below", "air_min", "air_degree_days_below"]
#: Days that a count, a level or a forecast may be old; rows that a training needs.
COUNT_AGE, LEVEL_LAG, FORECAST_AGE, LEAST_ROWS = 14, 3, 2, 30


def forecast_air(forecast: DataFrame, made_on: str) -> DataFrame:
    """day, low and mean of made_on and the day after, newest known of the forecasts (issued, day, low, mean) of the last days."""
    today = F.lit(made_on).cast("date")
    recent = forecast.where(F.col("issued").between(F.date_sub(today, FORECAST_AGE), today) & F.col("day").between(today, F.date_add(today, 1)))
    return newest_known(recent, ["day"], ["low", "mean"], "issued")


def feature_rows(days: DataFrame, counts: DataFrame, levels: DataFrame, air: DataFrame, threshold: float, keys: list[str] | None = None) -> DataFrame:
    """Per day of days, a prediction for the day after it: made_on, target, last_count, the FEATURES, and the
    reason for which they can't be built. counts has day and count, levels day and level, air day, low and
    mean, each a row a day; with keys, a row a day of each station. The level is the newest within LEVEL_LAG days;
    its change and sums are as of its day. Nothing of the target's day but its air is used."""
    by = keys or []
    known = days.select(*by, "day", F.lit(True).alias("_asked"))
    for other in (counts.select(*by, "day", "count"), levels.select(*by, "day", "level"), air.select(*by, "day", "low", "mean")):
        known = known.join(other, [*by, "day"], "full")
    w = W.partitionBy(*(by or [F.lit(0)])).orderBy("_k")  # without keys one series, of a row a day
    below = lambda v: F.greatest(F.lit(0.0), F.lit(threshold) - v)
    out = known.withColumn("_k", F.datediff("day", F.lit("1970-01-01").cast("date")))
    out = out.withColumn("_back", F.max("level").over(w.rangeBetween(-3, -3))).withColumn("_hours", F.sum(F.when(F.col("level").isNotNull(), degree_sum(F.col("level"), threshold))).over(w.rangeBetween(-2, 0)))
    out = out.withColumn("_last", F.last(F.when(F.col("count").isNotNull(), F.struct(F.col("count").alias("c"), F.col("_k").alias("at"))), ignorenulls=True).over(w.rangeBetween(W.unboundedPreceding, 0)))
    out = out.withColumn("_g", F.last(F.when(F.col("level").isNotNull(), F.struct("level", "_back", "_hours")), ignorenulls=True).over(w.rangeBetween(-LEVEL_LAG, 0)))
    out = out.withColumn("_low", F.max("low").over(w.rangeBetween(1, 1))).withColumn("_mean", F.max("mean").over(w.rangeBetween(1, 1)))
    age = F.col("_k") + 1 - F.col("_last.at")
    reason = F.coalesce(
        F.when(F.col("_last").isNull(), "no count on or before the day"), F.when(age > COUNT_AGE, f"last count over {COUNT_AGE} days before the target"),
        F.when(F.col("_g").isNull(), "no recent level"), F.when(F.col("_g._back").isNull(), "no level three days earlier"),
        F.when(F.col("_low").isNull() | F.col("_mean").isNull(), "no air for the target"), F.when(F.col("mean").isNull(), "no air for the day"),
    )
    values = [F.log1p("_last.c"), age.cast("double"), F.col("_g.level"), F.col("_g.level") - F.col("_g._back"), F.col("_g._hours"), F.col("_low"), below(F.col("mean")) + below(F.col("_mean"))]
    return out.where("_asked").select(*by, F.col("day").alias("made_on"), F.date_add("day", 1).alias("target"), F.col("_last.c").alias("last_count"), F.date_from_unix_date("_last.at").alias("last_count_date"), *(F.when(reason.isNull(), v).alias(n) for n, v in zip(FEATURES, values, strict=True)), reason.alias("reason"))


def training_frame(counts: DataFrame, levels: DataFrame, air: DataFrame, threshold: float, today: str) -> DataFrame:
    """A row for each counted day up to today, with the features as of the day before; rows that can't be built are left out."""
    targets = counts.where(F.col("count").isNotNull() & (F.col("day") <= F.lit(today).cast("date")))
    rows = feature_rows(targets.select(F.date_sub("day", 1).alias("day")), counts, levels, air, threshold).where("reason is null")
    return rows.join(targets.select(F.col("day").alias("target"), "count"), "target")


def train(frame: DataFrame, features: list[str] = FEATURES, y: str = "count") -> Fit | None:
    """The fit, or None if there are too few rows."""
    return fit(frame, features, y) if frame.count() >= LEAST_ROWS else None


def daily_prediction(fitted: Fit | None, season_open: bool, made_on: str, counts: DataFrame, levels: DataFrame, forecast: DataFrame, threshold: float) -> DataFrame | None:
    """The row of made_on with predicted, null if it has a reason; None out of season or without a model."""
    if not season_open or fitted is None:
        return None
    day = counts.sparkSession.range(1).select(F.lit(made_on).cast("date").alias("day"))
    return predicted(feature_rows(day, counts, levels, forecast_air(forecast, made_on), threshold), fitted)


def usable_counts(reports: DataFrame, table: str, quarantined: DataFrame, decisions: DataFrame) -> DataFrame:
    """Counted days (day, count, not_counted and others) that no open quarantine holds back."""
    known = reports.where(predicates.counted(F.col("count"), F.col("not_counted")))
    return state.gate(known, observation_id(table, F.col("day")), state.held_out(quarantined, decisions)).drop("obs_id")


def held_values(daily: DataFrame, table: str, day: str, measures: list[str], quarantined: DataFrame, decisions: DataFrame) -> DataFrame:
    """daily with the values nulled that a quarantine holds back; ids that name no day and measure are passed over."""
    part = lambda i: F.split_part("obs_id", F.lit(":"), F.lit(i))
    held = state.held_out(quarantined, decisions).where(F.col("obs_id").startswith(f"{table}:"))
    held = held.select(part(2).try_cast("date").alias(day), part(3).alias("_m")).where(F.col(day).isNotNull() & F.col("_m").isin(measures))
    flags = held.groupBy(day).agg(*(F.bool_or(F.col("_m") == m).alias(f"_{m}") for m in measures))
    out = daily.join(flags, day, "left")
    return out.withColumns({m: F.when(~F.coalesce(F.col(f"_{m}"), F.lit(False)), F.col(m)) for m in measures}).select(daily.columns)


def training_summary(frame: DataFrame) -> DataFrame:
    """One row: rows, rows of estimates, and the first and last target."""
    return frame.agg(F.count("*").alias("training_rows"), F.count_if(F.coalesce("is_estimate", F.lit(False))).alias("estimate_rows"), F.min("target").alias("first_target"), F.max("target").alias("last_target"))


VERSION = "model_version string, trained_on date, trained_at timestamp, family string, params string, training_rows long, estimate_rows long, first_target date, last_target date, season_open boolean, reason string"


def train_version(frame: DataFrame, versions: DataFrame, on: str, at: str, reason: str, season_open: bool, features: list[str] = FEATURES) -> DataFrame | None:
    """A row to append to versions, with what it was trained on and why; None with too few rows."""
    fitted = train(frame, features)
    if fitted is None:
        return None
    name = version_id(on, versions.where(F.col("model_version").startswith(f"m{on.replace('-', '')}-")).count())
    facts = [F.lit(name).alias("model_version"), F.lit(on).cast("date").alias("trained_on"), F.lit(at).cast("timestamp").alias("trained_at"), F.lit(fitted.family).alias("family"), F.lit(fitted.to_json()).alias("params")]
    return training_summary(frame).select(*facts, "training_rows", "estimate_rows", "first_target", "last_target", F.lit(season_open).alias("season_open"), F.lit(reason).alias("reason"))


def current(versions: DataFrame) -> DataFrame:
    """The version in use: the newest, of equals the last by name."""
    return versions.orderBy(F.desc("trained_at"), F.desc("model_version")).limit(1)


def predictions(features: DataFrame, version: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of predictions and of their inputs, of the feature rows without a reason, by a version's parameters."""
    row = version.first()
    if row is None:
        raise ValueError("there is no model")
    params = json.loads(row["params"])
    good = predicted(features.where("reason is null"), Fit(**params)).withColumn("model_version", F.lit(row["model_version"]))
    values = F.to_json(F.map_from_arrays(F.array(*(F.lit(f) for f in sorted(params["features"]))), F.array(*(F.col(f) for f in sorted(params["features"])))))
    return good.select("made_on", F.col("target").alias("target_date"), "predicted", "model_version"), good.select("made_on", F.col("target").alias("target_date"), "last_count", "last_count_date", values.alias("features"))


def scored(predicted_rows: DataFrame, inputs: DataFrame, counts: DataFrame, version: str | None = None, estimates: bool = True) -> DataFrame:
    """Predictions of days that were counted, with persistence and both errors; of a version, or without estimates, if asked."""
    known = counts.select(F.col("day").alias("report_date"), "count", "is_estimate")
    both = predicted_rows.join(inputs, ["made_on", "target_date"])
    out = both.join(known, both["target_date"] == known["report_date"])
    out = predicates.where_all(out, None if version is None else F.col("model_version") == version, None if estimates else ~F.coalesce("is_estimate", F.lit(False)))
    error = lambda c: F.abs(F.col(c) - F.col("count"))
    return out.select("made_on", "target_date", "model_version", "predicted", F.col("last_count").alias("persistence"), "count", "is_estimate", error("predicted").alias("model_error"), error("last_count").alias("persistence_error"))


def newest_scores(rows: DataFrame, n: int = 10) -> DataFrame:
    """Each version's n newest scores."""
    w = W.partitionBy("model_version").orderBy(F.desc("target_date"), F.desc("made_on"))
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def errors(scored: DataFrame, predicted: str, persistence: str, actual: str) -> DataFrame:
    return scored.agg(F.count("*").alias("n"), F.avg(F.abs(F.col(predicted) - F.col(actual))).alias("mae_model"), F.avg(F.abs(F.col(persistence) - F.col(actual))).alias("mae_persistence"))


@dataclass(frozen=True)
class Fit:
    family: str
    alpha: float | None
    features: list[str]
    coefficients: dict[str, float]
    fallback_reason: str | None = None

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)


def _sums(frame: DataFrame, xs: list[Column], weight: Column, target: Column) -> tuple[np.ndarray, np.ndarray]:
    """X'WX and X'Wz in one aggregate."""
    k = len(xs)
    cells = [F.sum(weight * xs[i] * xs[j]) for i in range(k) for j in range(i, k)] + [F.sum(weight * x * target) for x in xs]
    row = list(frame.agg(*[c.alias(f"s{i}") for i, c in enumerate(cells)]).first())
    a, at = np.zeros((k, k)), 0
    for i in range(k):
        for j in range(i, k):
            a[i, j] = a[j, i] = row[at]
            at += 1
    return a, np.array(row[at:], float)


def _linear(xs: list[Column], beta: np.ndarray) -> Column:
    out = F.lit(0.0)
    for x, b in zip(xs, beta, strict=True):
        out = out + x * F.lit(float(b))
    return out


def glm(frame: DataFrame, features: list[str], y: str, alpha: float = 0.0, rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Coefficients (constant first) of a count regression with log link by iteratively reweighted least
    squares: Poisson, or negative binomial of a fixed dispersion. Each round is one aggregate over the frame."""
    xs = [F.lit(1.0), *(F.col(c).cast("double") for c in features)]
    mean = frame.agg(F.avg(y)).first()[0]
    if not mean or mean <= 0:
        raise ValueError("no positive counts")
    beta = np.array([np.log(mean), *[0.0] * len(features)])
    for _ in range(rounds):
        eta = _linear(xs, beta)
        mu = F.exp(eta)
        a, b = _sums(frame, xs, mu / (1 + F.lit(alpha) * mu), eta + (F.col(y) - mu) / mu)
        try:
            new = np.linalg.solve(a, b)
        except np.linalg.LinAlgError:  # a feature without variation gets the least coefficients
            new = np.linalg.pinv(a, hermitian=True) @ b
        if not np.isfinite(new).all():
            raise ValueError("coefficients are not finite")
        if np.abs(new - beta).max() <= tolerance * (1 + np.abs(beta).max()):
            return new
        beta = new
    raise ValueError("no convergence")


def dispersion(frame: DataFrame, features: list[str], y: str, beta: np.ndarray) -> float:
    """Slope of the auxiliary regression, without a constant, of the excess variance on the mean."""
    mu = F.exp(_linear([F.lit(1.0), *(F.col(c).cast("double") for c in features)], beta))
    z = ((F.col(y) - mu) * (F.col(y) - mu) - F.col(y)) / mu
    row = frame.agg(F.sum(z * mu).alias("a"), F.sum(mu * mu).alias("b")).first()
    return float(row["a"] / row["b"])


def fit(frame: DataFrame, features: list[str], y: str) -> Fit:
    """Negative binomial if the data are over-dispersed and it converges, else Poisson with the reason."""
    beta = glm(frame, features, y)
    alpha, why = dispersion(frame, features, y, beta), None
    if not np.isfinite(alpha) or alpha <= 0:
        why = "dispersion isn't positive"
    else:
        try:
            beta = glm(frame, features, y, alpha)
        except (ValueError, np.linalg.LinAlgError) as e:
            why = str(e)
    names = ["const", *features]
    return Fit("poisson" if why else "negative_binomial", None if why else alpha, features, dict(zip(names, map(float, beta), strict=True)), why)


def predicted(df: DataFrame, fitted: Fit, out: str = "predicted") -> DataFrame:
    eta = F.lit(fitted.coefficients["const"])
    for c in fitted.features:
        eta = eta + F.col(c) * F.lit(fitted.coefficients[c])
    return df.withColumn(out, F.exp(eta))


def retrain_reason(has_model: bool, n_scored: int, mae_model: float | None, mae_persistence: float | None, season_open: bool, trained_since_close: bool) -> str | None:
    """Why to train again, the first that holds: no model, worse than persistence over ten scores, a closed season."""
    if not has_model:
        return "first_model"
    if n_scored >= 10 and mae_model is not None and mae_persistence is not None and mae_model > mae_persistence:
        return "lost_to_persistence"
    if not season_open and not trained_since_close:
        return "season_closed"
    return None


def version_id(day: str, earlier: int) -> str:
    return f"m{day.replace('-', '')}-{earlier + 1}"
