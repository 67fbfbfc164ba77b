"""Quality checks. Each gives verdicts (source, check_name, failed, detail); nothing to look at gives no row,
so that open incidents stay as they are."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.functions.calendar import weekdays_between


@dataclass(frozen=True)
class Thresholds:
    max_age_days: int = 2
    max_silent_weekdays: int = 2
    null_rate: float = 0.10
    retention: float = 0.90
    retention_days: int = 5
    deviation: float = 3.0
    jump_days: int = 4
    jump_least: float = 10
    jump_rise: float = 1.5
    jump_fall: float = 0.5
    shift: float = 2.0


def latest_success(runs: DataFrame, source: str = "source", status: str = "status", at: str = "started_at") -> DataFrame:
    return runs.groupBy(source).agg(F.max(F.when(F.col(status) == "succeeded", F.col(at))).alias("last_success"))


def freshness(last: DataFrame, today: Column, limits: Thresholds = Thresholds()) -> DataFrame:
    age = F.datediff(today, F.to_date("last_success"))
    return last.withColumn("age_days", age).withColumn("failed", F.coalesce(age > limits.max_age_days, F.lit(True)))


def report_freshness(last: DataFrame, today: Column, season_open: Column, limits: Thresholds = Thresholds()) -> DataFrame:
    """For a source that reports on weekdays, and only while its season is open."""
    silent = weekdays_between(F.to_date("last_success"), today)
    return last.withColumn("silent_weekdays", silent).withColumn("failed", season_open & F.coalesce(silent > limits.max_silent_weekdays, F.lit(True)))


def volume(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """counts (source, row_count) against expected (source, low, high; a null high has no limit). Unknown counts give no verdict."""
    joined = counts.where("row_count is not null").join(expected, "source")
    return joined.withColumn("failed", (F.col("row_count") < F.col("low")) | F.coalesce(F.col("row_count") > F.col("high"), F.lit(False)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """All columns' rates from one pass: rows (column, null_rate); none for an empty frame."""
    one = df.agg(F.count("*").alias("_rows"), *(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns)).where("_rows > 0")
    return one.unpivot([], columns, "column", "null_rate")


def cell_null_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """One rate over all cells of the columns; null without cells."""
    missing = sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0))
    return df.agg((F.sum(missing) / F.nullif(F.count("*") * len(columns), F.lit(0))).alias("null_rate"))


def jumps(df: DataFrame, day: str, value: str, days: int, least: float, rise: float, fall: float, keys: list[str] | None = None, temperatures: list[str] | None = None) -> DataFrame:
    """Rows that differ from the row before, a few days ago at most, by least and by the factors.

    With temperatures only a rise while one of them rose, or a fall while one fell, is told; a temperature that
    either day lacks says nothing. Without keys the series is one, of a row a day.
    """
    w = W.partitionBy(*(keys or [F.lit(0)])).orderBy(day)
    out = df.where(F.col(value).isNotNull()).withColumn("before", F.lag(value).over(w)).withColumn("before_on", F.lag(day).over(w))
    up, down = F.lit(temperatures is None), F.lit(temperatures is None)
    for t in temperatures or []:
        delta = F.col(t) - F.lag(t).over(w)
        out = out.withColumn(f"_{t}", delta)
        up, down = up | F.coalesce(F.col(f"_{t}") > 0, F.lit(False)), down | F.coalesce(F.col(f"_{t}") < 0, F.lit(False))
    big = (F.datediff(day, "before_on") <= days) & (F.abs(F.col(value) - F.col("before")) >= least)
    odd = ((F.col(value) > rise * F.col("before")) & up) | ((F.col(value) < fall * F.col("before")) & down)
    return out.where(big & odd).drop(*(f"_{t}" for t in temperatures or []))


def ranges(df: DataFrame, ids: list[str], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values out of their column's closed range, of an observation's columns the first in order."""
    out = [F.when(F.col(c).isNotNull() & ~F.col(c).between(lo, hi), F.struct(F.lit(c).alias("counter"), F.col(c).cast("double").alias("value"))) for c, (lo, hi) in bounds.items()]
    return df.withColumn("_bad", F.coalesce(*out)).where("_bad is not null").select(*ids, "_bad.counter", "_bad.value")


def retention(days: DataFrame, other: DataFrame, day: str, before: Column, least: int = 5, share: float = 0.9) -> DataFrame:
    """Share of the distinct days before a date that the other frame has; judged from so many days on."""
    mine = days.select(day).where(F.col(day) < before).distinct()
    there = other.select(day).distinct().withColumn("_there", F.lit(1))
    out = mine.join(there, day, "left").agg(F.count("*").alias("n_days"), F.avg(F.coalesce("_there", F.lit(0)).cast("double")).alias("kept"))
    return out.withColumn("judged", F.col("n_days") >= least).withColumn("failed", (F.col("n_days") >= least) & (F.col("kept") < share))


def guarded(source: str, check: str, build: Callable[[], DataFrame]) -> tuple[DataFrame | None, str | None]:
    """The frame of a check, or the text of the error with which it can't be built (a missing column, a bad type)."""
    try:
        df = build()
        df.schema  # noqa: B018  analysed here, under any kind of session
        return df, None
    except PySparkException as e:
        return None, f"{source}/{check}: {str(e)[:200]}"
