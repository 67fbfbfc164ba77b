"""Day-of-year baselines: circular smoothing, season averages, suspects, replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.functions.calendar import YEAR_DAYS, folded_day, years_before

HALF_WINDOW, TRAILING_YEARS = 7, 30


def smoothed(series: DataFrame, day: str, value: str, keys: list[str] | None = None, half: int = HALF_WINDOW) -> DataFrame:
    """keys, day_of_year, mean and sd: the mean of the daily means, and the root of the mean variance, of the
    days around each day of the year.

    Each day's pair is sent to the days that it counts for, so that the circular window is two hash
    aggregates over at most 365 rows a key and no join.
    """
    keys = keys or []
    daily = series.where(F.col(value).isNotNull()).groupBy(*keys, folded_day(F.col(day)).alias("d")).agg(F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    around = daily.withColumn("k", F.explode(F.array(*map(F.lit, range(-half, half + 1)))))
    target = (F.pmod(F.col("d") - 1 + F.col("k"), F.lit(YEAR_DAYS)) + 1).cast("int")
    return around.groupBy(*keys, target.alias("day_of_year")).agg(F.avg("m").alias("mean"), F.sqrt(F.avg("v")).alias("sd")).where("sd is not null")


def season_average(baseline: DataFrame, keys: list[str] | None = None, first: int = 305, last: int = 90) -> DataFrame:
    inside = (F.col("day_of_year") >= first) | (F.col("day_of_year") <= last)
    return baseline.groupBy(*(keys or [])).agg(F.avg(F.when(inside, F.col("mean"))).alias("season_mean"))


def unpivoted(df: DataFrame, ids: list[str], measures: list[str]) -> DataFrame:
    return df.unpivot(ids, measures, "measure", "value")


def suspects(long: DataFrame, baseline: DataFrame, day: str, width: float = 3.0) -> DataFrame:
    """Rows (day, measure, value) further from their baseline than so many deviations.

    A baseline has 365 rows a measure and key; whether it is broadcast is left to its size.
    """
    known = baseline.where("sd > 0")
    joined = long.withColumn("day_of_year", folded_day(F.col(day))).join(known, ["measure", "day_of_year"])
    return joined.where(F.abs(F.col("value") - F.col("mean")) > width * F.col("sd"))


def replayed(series: DataFrame, day: str, value: str, years: tuple[int, int], month: int = 4, live: set[str] | None = None) -> DataFrame:
    """refreshed_on, season_mean: the season average as each year's refresh would have found it.

    One job: a row counts for each refresh in the thirty years after it. Days of a live refresh are left out.
    """
    first, last = years
    dates = F.array(*[F.lit(f"{y}-{month:02d}-01").cast("date") for y in range(first, last + 1) if f"{y}-{month:02d}-01" not in (live or set())])
    each = series.withColumn("refreshed_on", F.explode(F.filter(dates, lambda r: (F.col(day) < r) & (F.col(day) >= years_before(r, TRAILING_YEARS)))))
    return season_average(smoothed(each, day, value, ["refreshed_on"]), ["refreshed_on"])


def drift(log: DataFrame, keys: list[str], at: str, new: str) -> DataFrame:
    """log with old_value, change and cumulative_change."""
    w = W.partitionBy(*(keys or [F.lit(0)])).orderBy(at)
    rows = log.withColumn("old_value", F.lag(new).over(w)).withColumn("change", F.col(new) - F.col("old_value"))
    run = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn("cumulative_change", F.sum(F.coalesce("change", F.lit(0.0))).over(run))


def normal(baseline: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """days with the mean and sd of their day of the year."""
    return days.withColumn("day_of_year", folded_day(F.col(day))).join(baseline, "day_of_year", "left")


def deviation(value: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd > 0, (value - mean) / sd)


def refresh(observed: DataFrame, day: str, source: str, baselines: DataFrame, log: DataFrame, on: str, replayed_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """The baselines and the log after a refresh on a day, from long rows (day, measure, value) before it.

    All measures in one job. A measure without a baseline keeps the old one and isn't logged. The log has the
    newest earlier value beside the new one. A baseline in force is replaced unless a later one is.
    """
    at = F.lit(on).cast("date")
    past = observed.where((F.col(day) < at) & (F.col(day) >= years_before(at, TRAILING_YEARS)))
    new = smoothed(past, day, "value", ["measure"]).withColumn("source", F.lit(source)).withColumn("refreshed_on", at)
    seasons = season_average(new, ["measure"]).where("season_mean is not null")
    before = log.where((F.col("source") == source) & (F.col("refreshed_on") < at)).groupBy("measure").agg(F.max_by("new_value", "refreshed_on").alias("old_value"))
    rows = seasons.join(before, "measure", "left").select(at.alias("refreshed_on"), F.lit(replayed_run).alias("replayed"), F.lit(source).alias("source"), "measure", "old_value", F.col("season_mean").alias("new_value"))
    keys = ["refreshed_on", "source", "measure"]
    logged = log.join(rows.select(keys), keys, "left_anti").unionByName(rows)
    later = baselines.where(F.col("refreshed_on") > at).select("source", "measure").distinct()
    taken = new.join(seasons.select("measure"), "measure", "left_semi").join(later, ["source", "measure"], "left_anti").select("source", "measure", "day_of_year", "mean", "sd", "refreshed_on")
    kept = baselines.join(taken.select("source", "measure").distinct(), ["source", "measure"], "left_anti")
    return kept.unionByName(taken), logged
