"""The watch as Structured Streaming: late rows within an overlap, keyed upserts by batch, windowed rollups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from obswatch.sources.store import Store


def rollup(stream: DataFrame, ts: str, keys: list[str], value: str, late: str = "10 days", width: str = "1 day") -> DataFrame:
    """Counts and means by window, of rows that come at most so late."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(F.col("w.start").alias("window_start"), *keys, "n", "mean")


def into_store(stream: DataFrame, store: Store, table: str, checkpoint: str, then: Callable[[int], None] | None = None) -> DataStreamWriter:
    """Upserts each batch; a batch that is run again after a failure gives the same table."""

    def batch(df: DataFrame, number: int) -> None:
        store.upsert({table: df})
        if then:
            then(number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def last_seen(stream: DataFrame, source: str, ts: str) -> DataFrame:
    """The newest event time of each source, for output in update or complete mode: source, last_seen."""
    return stream.groupBy(F.col(source).alias("source")).agg(F.max(ts).alias("last_seen"))


def freshness(seen: DataFrame, sources: DataFrame, now: Column, days: int = 2) -> DataFrame:
    """Whether a source's newest event is older than so many days; a source without any fails. For batches of last_seen."""
    late = F.coalesce(F.datediff(F.to_date(now), F.to_date("last_seen")) > days, F.lit(True))
    return sources.select("source").distinct().join(seen, "source", "left").withColumn("failed", late)


def incidents(verdicts: DataFrame) -> DataFrame:
    """Changes of incidents: source, check_name, opened_at, closed_at (null when one opens).

    verdicts: source, check_name, at, failed. A failure opens an incident where none is open, a pass closes
    it; the state of a check is the time at which its incident opened. Verdicts of a batch are taken by time,
    and a pass comes before a failure of the same time; null verdicts change nothing."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        opened = held.get[0] if held.exists else None
        out = []
        rows = pd.concat(list(parts)).dropna(subset=["at", "failed"]).sort_values(["at", "failed"], kind="stable")
        for at, failed in zip(rows["at"], rows["failed"], strict=True):
            if failed and opened is None:
                opened = at.to_pydatetime()
                out.append((*key, at, None))
            elif not failed and opened is not None:
                out.append((*key, pd.Timestamp(opened), at))
                opened = None
        if opened is not None:
            held.update((opened,))
        elif held.exists:
            held.remove()
        frame = pd.DataFrame(out, columns=["source", "check_name", "opened_at", "closed_at"])
        yield frame.astype({"opened_at": "datetime64[ns]", "closed_at": "datetime64[ns]"})

    return verdicts.groupBy("source", "check_name").applyInPandasWithState(step, "source string, check_name string, opened_at timestamp, closed_at timestamp", "opened timestamp", "append", GroupStateTimeout.NoTimeout)


def _closing(last: dt.date, not_before: dt.date, silent: int) -> dt.date:
    day = max(last + dt.timedelta(days=1), not_before)
    while True:
        silent -= day.weekday() < 5
        if not silent:
            return day
        day += dt.timedelta(days=1)


def season_changes(reports: DataFrame, ts: str, late: str = "7 days", anchor_month: int = 8, closes_from: tuple[int, int] = (3, 1), silent: int = 5) -> DataFrame:
    """A row when a winter opens and one when it closes: winter, status, opened_on, closed_on.

    A winter closes on the last weekday of its first silence, once the watermark has passed that day, or when a
    report after it comes first; it stays closed. Its days are kept as the first and the last report. Reports
    that come later than late are dropped by the watermark."""
    day = F.to_date(F.col(ts))
    winter = F.when(F.month(day) >= anchor_month, F.year(day)).otherwise(F.year(day) - 1)

    def step(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        year, out = key[0], []
        opened, last, closed = held.get if held.exists else (None, None, None)
        limit = dt.date(year + 1, *closes_from)

        def close() -> None:
            nonlocal closed
            closed = _closing(last, limit, silent)
            out.append((year, "closed", opened, closed))

        if held.hasTimedOut:
            if closed is None:
                close()
        else:
            for d in sorted(set(pd.concat(list(parts))["_day"].dropna())):
                if opened is None:
                    opened = last = d
                    out.append((year, "open", d, None))
                elif closed is None and d > _closing(last, limit, silent):
                    close()
                opened, last = min(opened, d), max(last, d)
        if opened is not None:
            held.update((opened, last, closed))
            if closed is None:
                due = dt.datetime.combine(_closing(last, limit, silent) + dt.timedelta(days=1), dt.time(), dt.timezone.utc)
                held.setTimeoutTimestamp(max(int(due.timestamp() * 1000), held.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["winter", "status", "opened_on", "closed_on"])

    rows = reports.withWatermark(ts, late).select(ts, day.alias("_day"), winter.cast("int").alias("winter")).where("_day is not null")
    return rows.groupBy("winter").applyInPandasWithState(step, "winter int, status string, opened_on date, closed_on date", "opened date, last date, closed date", "append", GroupStateTimeout.EventTimeTimeout)
