"""Text and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: Column) -> Column:
    """No-break spaces, degree signs, curly apostrophes and dashes made plain, white space squeezed and trimmed."""
    plain = F.replace(F.translate(text, "\u00a0º˚’–", " °°'-"), F.lit("—"), F.lit(" - "))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def number(text: Column) -> Column:
    """A finite number, else null."""
    x = F.expr("try_cast(NULL AS DOUBLE)") if text is None else text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def observation_id(table: Column | str, *key: Column) -> Column:
    table = F.lit(table) if isinstance(table, str) else table
    return F.concat_ws(":", table, *[k.cast("string") for k in key])


def sorted_json(values: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(values))))


def unit_problems(units: Column, pinned: dict[str, str]) -> Column:
    """Sorted names of the fields whose unit isn't the pinned one; unreadable JSON is one problem."""
    parsed = F.from_json(units, "map<string,string>", {"mode": "PERMISSIVE"})
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(F.element_at(parsed, k) == v, F.lit(False)), F.lit(k)) for k, v in sorted(pinned.items())]))
    return F.when(parsed.isNull() | units.isNull(), F.array(F.lit("unreadable"))).otherwise(bad)


def squeezed(value: Column, length: int) -> Column:
    return F.substring(value, 1, length)


def fingerprint(ids: Column) -> Column:
    """sha256 of sorted ids, the key under which an alert is sent once."""
    return F.sha2(F.array_join(F.array_sort(ids), "\n"), 256)


def convert(value: Column, factor: float, offset: float) -> Column:
    return value * F.lit(factor) + F.lit(offset)


def celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5 / 9
