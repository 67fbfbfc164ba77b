"""The watch's checks put together: verdicts (source, check_name, failed, detail), suspects and measures.

A verdict is there only if there is something to judge. Every check names its source, so that one which can't be
computed fails that source's schema check and no other (plans.daily.run_checks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obswatch.functions.calendar import weekdays_between
from obswatch.functions.text import observation_id, unit_problems
from obswatch.operators import baselines, checks, predicates, series
from obswatch.operators.checks import Thresholds

VERDICT = ["source", "check_name", "failed", "detail"]


def verdicts(df: DataFrame, check: str | Column, failed: Column, detail: Column, source: str | Column | None = None) -> DataFrame:
    """df's rows as verdicts; a passed check has no detail."""
    name = F.lit(check) if isinstance(check, str) else check
    of = F.col("source") if source is None else F.lit(source) if isinstance(source, str) else source
    return df.select(of.cast("string").alias("source"), name.alias("check_name"), failed.alias("failed"), F.when(failed, F.substring(detail, 1, 200)).otherwise(F.lit("")).alias("detail"))


def freshness(sources: DataFrame, runs: DataFrame, today: Column, limits: Thresholds = Thresholds()) -> DataFrame:
    """Every source of the list has a verdict: one that never succeeded fails."""
    last = sources.select("source").join(checks.latest_success(runs), "source", "left")
    age = F.datediff(today, F.to_date("last_success"))
    failed = F.coalesce(age > limits.max_age_days, F.lit(True))
    told = F.coalesce(F.format_string("last success %s, %d days ago, limit %d", F.to_date("last_success").cast("string"), age, F.lit(limits.max_age_days)), F.lit(""))
    return verdicts(last.withColumn("_age", age), "freshness", failed, F.when(F.col("last_success").isNull(), "never succeeded").otherwise(told))


def report_freshness(reports: DataFrame, day: str, season: DataFrame, today: Column, source: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """A source that reports on weekdays is judged by its last report while its season is open or overdue; else it passes."""
    last = reports.agg(F.max(day).alias("last")).join(F.broadcast(season.select("status")))  # one row each
    silent = F.coalesce(weekdays_between(F.col("last"), today), F.lit(limits.max_silent_weekdays + 1))
    failed = F.col("status").isin("open", "overdue") & (silent > limits.max_silent_weekdays)
    return verdicts(last, "freshness", failed, F.format_string("%d weekdays without a report", silent), source)


def season_overdue(season: DataFrame, source: str) -> DataFrame:
    return verdicts(season, "season_overdue", F.col("status") == "overdue", F.lit("no report of a season that should have begun"), source)


def volume(counts: DataFrame, expected: DataFrame) -> DataFrame:
    bounds = F.concat_ws(" to ", F.col("low").cast("string"), F.col("high").cast("string"))
    return verdicts(checks.volume(counts, expected), "volume", F.col("failed"), F.concat(F.col("row_count").cast("string"), F.lit(" rows, expected "), bounds))


def duplicates(tables: dict[str, tuple[DataFrame, list[str]]], source: str) -> DataFrame:
    """One verdict for all of a source's tables."""
    each = [checks.duplicate_keys(df, keys).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, (df, keys) in sorted(tables.items())]
    both = each[0]
    for x in each[1:]:
        both = both.unionByName(x)
    told = F.array_join(F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.format_string("%d keys repeat in %s", F.col("n"), F.col("name"))))), "; ")
    one = both.agg(F.sum("n").alias("n"), told.alias("told"))  # a row a table
    return verdicts(one, "duplicates", F.col("n") > 0, F.col("told"), source)


def null_rates(df: DataFrame, columns: list[str], source: str, where: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """A verdict a column; none of an empty frame. where says which rows these are."""
    one = df.agg(F.count("*").alias("_rows"), *(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns)).where("_rows > 0")
    long = one.unpivot(["_rows"], columns, "column", "rate")
    told = F.concat(F.format_string("%.0f%% null in %d rows", F.col("rate") * 100, F.col("_rows")), F.lit(f" ({where}), limit {limits.null_rate:.0%}"))
    return verdicts(long, F.concat(F.lit("null_rate:"), F.col("column")), F.col("rate") > limits.null_rate, told, source)


def lagged_window(df: DataFrame, day: Column, today: Column, lag: int = 6, days: int = 14) -> DataFrame:
    """The rows of so many days that end where late values may still be missing."""
    end = F.date_sub(today, lag)
    return df.where((day >= F.date_sub(end, days)) & (day < end))


def newest_issue(df: DataFrame, issued: str) -> DataFrame:
    return predicates.since_last(df, F.col(issued), 0)


def units(rows: DataFrame, source: str, runs: DataFrame, unit: str, pinned: dict[str, str] | list[str]) -> DataFrame:
    """Units of the latest successful run's rows: a JSON of fields against pinned ones, or a text against a list."""
    mine = predicates.of_last_run(rows, runs, source).select(unit).distinct()  # few different units
    if isinstance(pinned, dict):
        bad = mine.select(F.explode_outer(unit_problems(F.col(unit), pinned)).alias("p"))
    else:
        bad = mine.select(F.when(~F.coalesce(F.col(unit).isin(pinned), F.lit(False)), F.concat(F.lit("unit "), F.coalesce(F.col(unit), F.lit("unknown")))).alias("p"))
    one = bad.agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("p")), "; ").alias("told")).where("n > 0")
    return verdicts(one, "units", F.col("told") != "", F.col("told"), source)


SUSPECT = ["obs_id", "source", "observation_date", "check_name", "value"]


def weather_suspects(daily: DataFrame, baseline: DataFrame, table: str, source: str, day: str, measures: list[str], since: Column, today: Column, limits: Thresholds = Thresholds()) -> DataFrame:
    long = baselines.unpivoted(daily.where(F.col(day).between(since, today)), [day], measures)
    out = baselines.suspects(long, baseline, day, limits.deviation)
    return out.select(observation_id(table, F.col(day), F.col("measure")).alias("obs_id"), F.lit(source).alias("source"), F.col(day).alias("observation_date"), F.lit("weather_normal").alias("check_name"), F.col("value").cast("string").alias("value"))


def range_suspects(rows: DataFrame, table: str, source: str, day: str, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """A day's first counter out of its bounds."""
    out = checks.ranges(rows, [day], bounds)
    return out.select(observation_id(table, F.col(day)).alias("obs_id"), F.lit(source).alias("source"), F.col(day).alias("observation_date"), F.lit("count_range").alias("check_name"), F.concat_ws("=", "counter", F.col("value").cast("string")).alias("value"))


def jump_suspects(rows: DataFrame, table: str, source: str, day: str, value: str, temperatures: list[str], since: Column, keys: list[str] | None = None, limits: Thresholds = Thresholds()) -> DataFrame:
    """Rises while it gets warmer by any temperature, and falls while it gets colder."""
    near = rows.where(F.col(day) >= F.date_sub(since, limits.jump_days))
    out = checks.jumps(near, day, value, limits.jump_days, limits.jump_least, limits.jump_rise, limits.jump_fall, keys, temperatures).where(F.col(day) >= since)
    return out.select(*(keys or []), observation_id(table, *(F.col(k) for k in keys or []), F.col(day)).alias("obs_id"), F.lit(source).alias("source"), F.col(day).alias("observation_date"), F.lit("count_jump").alias("check_name"), F.col(value).cast("string").alias("value"))


def disagreement(rows: DataFrame, day: str, a: str, b: str, since: Column) -> DataFrame:
    """The measure counter_disagreement: one counter less the other, on days with both."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(day) >= since))
    return both.select(F.lit("counter_disagreement").alias("measure"), F.col(day).cast("string").alias("obs_key"), F.col(day).alias("observation_date"), (F.col(a) - F.col(b)).cast("double").alias("value"))


def trailing_shift(days: DataFrame, day: str, diff: str, n: int = 30, least: int = 5, keys: list[str] | None = None, limits: Thresholds = Thresholds()) -> DataFrame:
    """days with the median of the differences before them, and whether theirs is shifted from it."""
    out = days.withColumn("median_before", series.trailing_median(F.col(diff), [day], n, least, keys))
    return out.withColumn("shifted", F.coalesce(F.abs(F.col(diff) - F.col("median_before")) > limits.shift, F.lit(False)))


def cross_source(days: DataFrame, day: str, a: str, b: str, source: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """The last day's difference of two sources against the median of those before it."""
    both = days.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_diff", F.col(a) - F.col(b))
    last = trailing_shift(both, day, "_diff", limits=limits).where("median_before is not null").orderBy(F.desc(day)).limit(1)
    newest = predicates.since_last(both, F.col(day), 0).select(day)
    told = F.format_string("difference %+.1f, usually %+.1f", F.col("_diff"), F.col("median_before"))
    return verdicts(last.join(F.broadcast(newest), day, "left_semi"), "cross_source_shift", F.col("shifted"), told, source)


def retention(days: DataFrame, other: DataFrame, day: str, end: Column, source: str, name: str, limits: Thresholds = Thresholds()) -> tuple[DataFrame, DataFrame]:
    """The verdict join_retention:<name>, and the measure, which is kept for any day there is."""
    one = checks.retention(days, other, day, end, limits.retention_days, limits.retention)
    told = F.format_string("%.0f%% of %d days joined", F.col("kept") * 100, F.col("n_days"))
    measure = one.where("n_days > 0").select(F.lit(f"join_retention:{name}").alias("measure"), end.cast("string").alias("obs_key"), end.alias("observation_date"), F.col("kept").alias("value"))
    return verdicts(one.where("judged"), f"join_retention:{name}", F.col("failed"), told, source), measure


def alert(incidents: DataFrame, quarantined: DataFrame, today: str) -> DataFrame:
    """One row (subject, text, key) about items that nobody was told of, or none. The key is the same for the same items.

    Items are those of a day's run, some hundred lines.
    """
    told = lambda df: df.where("alerted_at is null")
    lines = told(incidents).where("closed_at is null").select(F.lit(0).alias("k"), F.col("incident_id").alias("id"), F.concat_ws("", F.lit("- "), "source", F.lit(" / "), "check_name", F.lit(": "), F.when(F.coalesce("detail", F.lit("")) != "", F.col("detail")).otherwise("failed")).alias("line"))
    lines = lines.unionByName(told(quarantined).select(F.lit(1).alias("k"), F.col("obs_id").alias("id"), F.concat_ws("", F.lit("- "), "obs_id", F.lit(" ("), "check_name", F.lit("): "), F.coalesce("value", F.lit("unknown"))).alias("line")))
    one = lines.agg(F.array_sort(F.collect_list(F.struct("k", "id", "line"))).alias("x")).where("size(x) > 0")
    n = lambda k: F.size(F.filter("x", lambda r: r["k"] == k))
    count = lambda k, what: F.when(n(k) > 0, F.concat(n(k).cast("string"), F.lit(f" new {what}"), F.when(n(k) > 1, "s").otherwise("")))
    key = F.sha2(F.array_join(F.array_sort(F.transform("x", lambda r: r["id"])), "\n"), 256)
    return one.select(F.concat(F.lit(f"Watch of {today}: "), F.concat_ws(", ", count(0, "incident"), count(1, "quarantined observation"))).alias("subject"), F.array_join(F.transform("x", lambda r: r["line"]), "\n").alias("text"), key.alias("key"))


def mark_alerted(items: DataFrame, key: str, told: DataFrame, now: Column) -> DataFrame:
    """items with alerted_at set on those listed, by their first column, that have none yet."""
    ids = told.select(F.col(told.columns[0]).alias(key)).distinct().withColumn("_told", F.lit(True))
    return items.join(ids, key, "left").withColumn("alerted_at", F.when(F.col("alerted_at").isNull() & F.col("_told"), now).otherwise(F.col("alerted_at"))).drop("_told").select(items.columns)
