"""Filters that reports and checks share: rows of the last run, three-valued reports, prefixes, optional conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_run(runs: DataFrame, source: str) -> DataFrame:
    """run_id of the source's latest successful run: one row, or none."""
    return runs.where((F.col("source") == source) & (F.col("status") == "succeeded")).orderBy(F.desc("started_at"), F.desc("run_id")).select("run_id").limit(1)


def of_last_run(rows: DataFrame, runs: DataFrame, source: str) -> DataFrame:
    """The rows that the source's latest successful run wrote."""
    return rows.join(F.broadcast(last_run(runs, source)), "run_id", "left_semi")  # one row


def reported(*values: Column, not_counted: Column) -> Column:
    """A day has a report if a value is known or it says that nothing was counted; an unknown flag says nothing."""
    return F.coalesce(reduce(lambda a, b: a | b, [v.isNotNull() for v in values]) | not_counted, F.lit(False))


def counted(value: Column, not_counted: Column) -> Column:
    """A known count of a day that isn't marked as not counted; zero is a count."""
    return value.isNotNull() & ~F.coalesce(not_counted, F.lit(False))


def any_known(*values: Column) -> Column:
    return F.coalesce(*values).isNotNull()


def starts(value: Column, prefix: str) -> Column:
    """Whether a text starts with a prefix, whatever its case; an unknown one doesn't."""
    return F.lower(F.coalesce(value, F.lit(""))).startswith(prefix.lower())


def where_all(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """df with those of the conditions that are asked for."""
    asked = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, asked)) if asked else df


def since_last(df: DataFrame, day: Column, days: int) -> DataFrame:
    """Rows of the days up to the last day that there is, so many before it included."""
    last = df.agg(F.max(day).alias("_last"))
    return df.join(F.broadcast(last), day >= F.date_sub("_last", days)).drop("_last")  # one row


def of_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")


def oldest_first(df: DataFrame, at: str, tie: str) -> DataFrame:
    return df.orderBy(F.col(at).asc_nulls_first(), F.col(tie).asc_nulls_first())


def blank_first(df: DataFrame, text: list[str], tie: str) -> DataFrame:
    """Sorted by texts, an unknown one as if it were blank."""
    return df.orderBy(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text), F.col(tie))
