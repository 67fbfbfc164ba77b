"""Raw payloads to typed rows: parallel arrays, GeoJSON features, pages of JSON, typed CSV, windows to fetch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obswatch.functions.calendar import local_date
from obswatch.functions.text import number
from obswatch.operators.series import latest


def landed(spark: SparkSession, path: str) -> DataFrame:
    """Whole files: path and payload."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("payload"))


def parallel_rows(raw: DataFrame, payload: str, block: str, fields: list[str], time: str = "time") -> DataFrame:
    """A block of equally long arrays as rows, with their position. A missing block or field, or arrays of
    unequal lengths, raise an error when the rows are computed."""
    inner = f"{time}: array<string>, " + ", ".join(f"{f}: array<double>" for f in fields)
    parsed = raw.withColumn("_b", F.from_json(payload, f"struct<{block}: struct<{inner}>>")[block])
    same = F.lit(True)
    for f in fields:
        same = same & F.coalesce(F.size(F.col("_b")[f]) == F.size(F.col("_b")[time]), F.lit(False)) & (F.size(F.col("_b")[f]) >= 0)
    checked = F.when(same, F.arrays_zip(*[F.col("_b")[c].alias(c) for c in (time, *fields)])).otherwise(F.raise_error(F.lit(f"block {block} lacks a field, or its arrays differ in length")))
    zipped = parsed.withColumn("_z", checked).drop("_b")
    return zipped.select(*raw.columns, F.posexplode("_z").alias("position", "_r")).select(*raw.columns, "position", *(F.col(f"_r.{c}").alias(c) for c in (time, *fields)))


def forecast_rows(raw: DataFrame, payload: str, block: str, fields: list[str], issued_at: Column, zone: str = "America/New_York") -> DataFrame:
    """A forecast's block: target_date, and issue_date, the local day on which it was fetched."""
    rows = parallel_rows(raw, payload, block, fields)
    return rows.withColumn("target_date", F.col("time").cast("date")).withColumn("issue_date", local_date(issued_at, zone)).drop("time", "position")


def hourly_rows(raw: DataFrame, payload: str, block: str, fields: list[str]) -> DataFrame:
    """An hourly block: observed_at is a local time without a zone; a text that is no time raises an error."""
    rows = parallel_rows(raw, payload, block, fields)
    return rows.withColumn("observed_at", F.col("time").cast("timestamp_ntz")).drop("time", "position")


def archive_rows(raw: DataFrame, payload: str, daily: list[str], hourly: list[str]) -> dict[str, DataFrame]:
    """Both blocks of an archive payload, to be written in one commit: if either can't be parsed, neither is written."""
    days = parallel_rows(raw, payload, "daily", daily).withColumn("obs_date", F.col("time").cast("date")).drop("time", "position")
    return {"daily": days.drop(payload), "hourly": hourly_rows(raw, payload, "hourly", hourly).drop(payload)}


def season_pages(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """Of landed pages, each season's first candidate file that is there: season, path, payload.

    candidates: season, rank, name (the last part of a path). A season without any has a null path and payload."""
    named = pages.withColumn("name", F.regexp_extract("path", "[^/]+$", 0))
    found = latest(candidates.join(named, "name"), ["season"], F.asc("rank"), F.asc("path"))
    return candidates.select("season").distinct().join(found.select("season", "path", "payload"), "season", "left")


def features(raw: DataFrame, payload: str) -> DataFrame:
    """GeoJSON pages (a JSON array of page texts) as rows: obs_date, value, unit, approval_status."""
    props = "struct<time: string, value: string, unit_of_measure: string, approval_status: string>"
    pages = raw.select(*[c for c in raw.columns if c != payload], F.explode(F.from_json(payload, "array<string>")).alias("_page"))
    each = pages.withColumn("_f", F.explode(F.from_json("_page", f"struct<features: array<struct<properties: {props}>>>")["features"])).withColumn("_p", F.col("_f.properties"))
    keep = [c for c in raw.columns if c != payload]
    return each.select(*keep, F.to_date(F.substring("_p.time", 1, 10)).alias("obs_date"), number(F.col("_p.value")).alias("value"), F.col("_p.unit_of_measure").alias("unit"), F.col("_p.approval_status").alias("approval_status"))


def paged(fetch: Callable[[str], dict], url: str, most: int = 100) -> Iterator[dict]:
    """Pages that follow their next links: an empty page ends them; a foreign host, a repeated link or too many pages fail."""
    host, seen = urlparse(url).netloc, {url}
    for _ in range(most):
        page = fetch(url)
        yield page
        link = next((x.get("href") for x in page.get("links", []) if x.get("rel") == "next"), None)
        if not page.get("features") or not link:
            return
        if urlparse(link).netloc not in ("", host):
            raise ValueError("a next link leads to another host")
        if link in seen:
            raise ValueError("a next link is repeated")
        seen.add(link)
        url = link
    raise ValueError(f"over {most} pages")


def typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def catch_up(last_success: dt.date | None, overlap: int, first: dt.date, today: dt.date) -> dt.date:
    """Where a window starts: some days before the last success, never after today."""
    return min(today, first if last_success is None else last_success - dt.timedelta(days=overlap))


def year_window(year: int, today: dt.date) -> tuple[dt.date, dt.date] | None:
    """A year's window, cut at yesterday; none for years to come."""
    end = min(dt.date(year, 12, 31), today - dt.timedelta(days=1))
    return (dt.date(year, 1, 1), end) if end >= dt.date(year, 1, 1) else None


def fetch_window(last_success: dt.date | None, overlap: int, first: dt.date, today: dt.date, lag: int = 0) -> tuple[dt.date, dt.date] | None:
    """Days to fetch, both ends included: from the overlap to some days before today; none if nothing is due."""
    start, end = catch_up(last_success, overlap, first, today), today - dt.timedelta(days=lag)
    return (start, end) if start <= end else None


def backfill(first: int, last: int, today: dt.date, run: Callable[[dt.date, dt.date], object]) -> dict[int, str]:
    """Runs each year's window, and gives the errors of the years that failed; the other years go on."""
    failed = {}
    for year in range(first, last + 1):
        window = year_window(year, today)
        if window is None:
            break
        try:
            run(*window)
        except Exception as e:  # a year doesn't depend on another
            failed[year] = str(e)[:200]
    return failed
