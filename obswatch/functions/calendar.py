"""Calendars of daily series: leap-folded days, weekdays, local days, seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days of a folded year; 29 February shares the number of the 28th.
YEAR_DAYS = 365


def folded_day(day: Column) -> Column:
    """Day of the year from 1 to 365 in which every 1 March is day 60."""
    m, d = F.month(day), F.dayofmonth(day)
    return F.dayofyear(F.make_date(F.lit(2001), m, F.when((m == 2) & (d == 29), 28).otherwise(d)))


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def weekdays_between(after: Column, through: Column) -> Column:
    """Weekdays in (after, through]; none if through isn't later. Closed form, so long spans cost nothing."""

    def upto(d: Column) -> Column:  # weekdays from Monday 1 January 1900 through d
        n = F.datediff(d, F.lit("1900-01-01").cast("date")) + 1
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    return F.when(through > after, upto(through) - upto(after)).otherwise(F.lit(0)).cast("int")


def local_date(utc: Column, zone: str = "America/New_York") -> Column:
    """The day in a zone of a UTC timestamp without a zone of its own."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz")))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def season_label(day: Column, first_month: int = 7) -> Column:
    """The year's label, such as 2025-2026, of years that start in a month."""
    y = F.when(F.month(day) >= first_month, F.year(day)).otherwise(F.year(day) - 1)
    return F.concat_ws("-", y.cast("string"), (y + 1).cast("string"))


def season_anchor(day: Column, first_month: int = 8) -> Column:
    y = F.when(F.month(day) >= first_month, F.year(day)).otherwise(F.year(day) - 1)
    return F.make_date(y, F.lit(first_month), F.lit(1))


def years_before(day: Column, years: int) -> Column:
    return F.add_months(day, -12 * years)


def naive_utc(local: Column, zone: str) -> Column:
    """A zone's wall clock as UTC without a zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local.cast("timestamp_ntz"))


def previous_season(label: Column) -> Column:
    first = F.split_part(label, F.lit("-"), F.lit(1)).cast("int")
    return F.concat_ws("-", (first - 1).cast("string"), first.cast("string"))


def csv_date(text: Column) -> Column:
    """A date written as text; null if it is none."""
    return text.try_cast("date")


def iso_time(text: Column) -> Column:
    """The UTC time of a text such as 2024-02-01T10:00:00Z, without a zone; null if it is none."""
    return F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit("")).try_cast("timestamp_ntz")


def is_stale(at: Column, now: Column, days: int) -> Column:
    """Whether data are older than so many whole days; unknown data are."""
    return F.coalesce(F.unix_seconds(now) - F.unix_seconds(at) > days * 86400, F.lit(True))
