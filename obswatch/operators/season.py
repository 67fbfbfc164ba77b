"""The state of a season: awaiting, overdue, open or closed. Reports open it, silence after a date closes it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obswatch.operators.series import first_silence


def state(reports: DataFrame, day: str, today: str, anchor_month: int = 8, overdue_after: tuple[int, int] = (11, 15), closes_from: tuple[int, int] = (3, 1), silent: int = 5) -> DataFrame:
    """One row: winter, status, opened_on, last_report, closed_on. Once closed, a winter stays closed."""
    now = F.to_date(F.lit(today))
    y = F.when(F.month(now) >= anchor_month, F.year(now)).otherwise(F.year(now) - 1)
    anchor, close = F.make_date(y, F.lit(anchor_month), F.lit(1)), F.make_date(y + 1, F.lit(closes_from[0]), F.lit(closes_from[1]))
    days = reports.select(F.col(day).alias("d")).where((F.col("d") >= anchor) & (F.col("d") <= now)).distinct().withColumn("winter", y)
    seen = days.groupBy("winter").agg(F.min("d").alias("opened_on"), F.max("d").alias("last_report"))
    closed = first_silence(days, ["winter"], "d", now, close, silent)
    one = reports.sparkSession.range(1).select(y.alias("winter")).join(seen, "winter", "left").join(closed, "winter", "left")
    late = now > F.make_date(F.col("winter"), F.lit(overdue_after[0]), F.lit(overdue_after[1]))
    status = F.when(F.col("closed_on").isNotNull(), "closed").when(F.col("opened_on").isNotNull(), "open").when(late, "overdue").otherwise("awaiting")
    return one.withColumn("status", status)


def refresh_due(season: DataFrame, refreshes: DataFrame, today: str) -> bool:
    """Whether a closed season still lacks a refresh of its own."""
    row = season.first()
    if row["status"] != "closed" or str(row["closed_on"]) > today:
        return False
    return refreshes.where((~F.col("replayed")) & (F.col("refreshed_on") >= F.lit(row["closed_on"]))).isEmpty()
