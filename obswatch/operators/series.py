"""Ordered series: as-of lookups, trailing statistics, lags, latest rows, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _order(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order, such as the newest."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def last_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """In a batch, the last record of a key replaces earlier ones."""
    return latest(df, keys, F.desc(ordinal))


def asof(spine: DataFrame, events: DataFrame, key: list[str], at: str, value: str, tolerance: int | None = None, days: bool = False) -> DataFrame:
    """spine with value and its time (value_at): of the events at or before each spine row, the latest.

    Both sides are put in one ordered frame, so that the plan is one shuffle on the key and one sort, and no
    row meets all events of its key. tolerance: seconds, or days, that the event may be older; seconds are
    compared to the microsecond. As in a join, a null key or time meets no event.
    """
    events = events.dropna(subset=[*key, at])
    a = spine.withColumn("_event", F.lit(None).cast(events.schema[value].dataType)).withColumn("_at", F.lit(None).cast(events.schema[at].dataType)).withColumn("_spine", F.lit(1))
    b = events.select(*key, at, F.col(value).alias("_event"), F.col(at).alias("_at"), F.lit(0).alias("_spine"))
    both = a.unionByName(b, allowMissingColumns=True)
    w = W.partitionBy(*key).orderBy(F.col(at), F.col("_spine")).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = F.last(F.when(F.col("_spine") == 0, F.struct("_event", "_at")), ignorenulls=True).over(w)
    out = both.withColumn("_hit", found).where("_spine = 1")
    if tolerance is None:
        keep = F.lit(True)
    elif days:
        keep = F.datediff(F.col(at), F.col("_hit._at")) <= tolerance
    elif isinstance(spine.schema[at].dataType, T.TimestampType):
        keep = F.unix_micros(F.col(at)) - F.unix_micros(F.col("_hit._at")) <= tolerance * 1_000_000
    else:  # without a zone: no clock changes between the two
        keep = F.col(at).cast("timestamp_ntz") - F.col("_hit._at").cast("timestamp_ntz") <= F.make_dt_interval(secs=F.lit(tolerance))
    return out.withColumn("value", F.when(keep, F.col("_hit._event"))).withColumn("value_at", F.when(keep, F.col("_hit._at"))).drop("_hit", "_event", "_at", "_spine")


def trailing_mean(df: DataFrame, value: str, key: list[str], order: list[str], n: int, out: str) -> DataFrame:
    """df with the mean of the previous n values that aren't null, without the current one."""
    w = W.partitionBy(*key).orderBy(*map(_order, order))
    run = w.rowsBetween(W.unboundedPreceding, -1)
    numbered = df.withColumn("_n", F.coalesce(F.count(value).over(run), F.lit(0)))
    # the m-th known value is at 2 m; a row without one, after m of them, at 2 m + 1: ranges of places are then
    # ranges of known values
    placed = numbered.withColumn("_k", F.when(F.col(value).isNotNull(), 2 * F.col("_n") + 2).otherwise(2 * F.col("_n") + 1))
    known = F.avg(F.when(F.col("_k") % 2 == 0, F.col(value)))
    places = W.partitionBy(*key).orderBy("_k")
    mean = F.when(F.col("_k") % 2 == 0, known.over(places.rangeBetween(-2 * n, -1))).otherwise(known.over(places.rangeBetween(-2 * n + 1, -1)))
    return placed.withColumn(out, mean).drop("_n", "_k")


def trailing_median(value: Column, order: list[str], n: int, least: int, key: list[str] | None = None) -> Column:
    """Median of the previous n rows without the current one; null if there are fewer than least."""
    w = W.partitionBy(*(key or [F.lit(0)])).orderBy(*map(_order, order)).rowsBetween(-n, -1)
    return F.when(F.count(value).over(w) >= least, F.percentile(value, F.lit(0.5)).over(w))


def running_sum(value: Column, key: list[str], order: list[str]) -> Column:
    w = W.partitionBy(*key).orderBy(*map(_order, order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.sum(F.coalesce(value, F.lit(0.0))).over(w)


def blocks(df: DataFrame, key: list[str], position: str, lead: Column, text: str) -> DataFrame:
    """Rows that don't lead join the last one that does: key, block, n_parts, text. Rows before the first lead go."""
    w = W.partitionBy(*key).orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = df.withColumn("block", F.sum(F.when(lead, 1).otherwise(0)).over(w)).where("block > 0")
    parts = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))
    return numbered.groupBy(*key, "block").agg(F.count("*").alias("n_parts"), F.array_join(F.transform(parts, lambda x: x["t"]), " ").alias("text"))


def first_silence(days: DataFrame, key: list[str], day: str, until: Column, not_before: Column, silent: int = 5) -> DataFrame:
    """The weekday on which a silence of so many weekdays first ends, by key; weekdays count strictly before
    the next report, or before until after the last one, and from not_before on."""
    from obswatch.functions.calendar import is_weekday

    w = W.partitionBy(*key).orderBy(day)
    gaps = days.select(*key, day).distinct().withColumn("_next", F.coalesce(F.lead(day).over(w), until))
    gaps = gaps.withColumn("_from", F.greatest(F.date_add(day, 1), not_before)).where(F.col("_from") <= F.date_sub("_next", 1))
    each = gaps.withColumn("_d", F.explode(F.sequence("_from", F.date_sub("_next", 1)))).where(is_weekday(F.col("_d")))
    nth = each.withColumn("_n", F.row_number().over(W.partitionBy(*key, day).orderBy("_d"))).where(F.col("_n") == silent)
    return nth.groupBy(*key).agg(F.min("_d").alias("closed_on"))
