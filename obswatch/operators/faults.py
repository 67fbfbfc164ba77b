"""Seeded faults, to prove that checks see them. The sample is the rows with the least hashes of seed and key."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sampled(df: DataFrame, keys: list[str], rate: float, seed: int) -> DataFrame:
    """Rows with _hash and the share's _limit: the share is a rank, found by counts of hash prefixes, not by a sort."""
    rows = df.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 1))
    n = rows.count()
    k = round(rate * n)
    if k == 0:
        return rows.withColumn("_limit", F.lit(-1).cast("long"))
    low, bits = 0, 63
    left = k
    while bits > 0:  # narrow down the k-th least hash, 12 bits at a time
        step = min(12, bits)
        part = F.expr(f"shiftright(_hash, {bits - step})")
        inside = rows.where(F.expr(f"shiftright(_hash, {bits}) = {low}L")) if bits < 63 else rows
        for r in inside.groupBy(part.alias("p")).count().orderBy("p").collect():
            if r["count"] >= left:
                low = r["p"]
                break
            left -= r["count"]
        bits -= step
    return rows.withColumn("_limit", F.lit(low).cast("long"))


def null_spike(df: DataFrame, column: str, keys: list[str], rate: float, seed: int = 0) -> DataFrame:
    """A share of the values that aren't null becomes null."""
    there = _sampled(df.where(F.col(column).isNotNull()), keys, rate, seed)
    hit = there.withColumn(column, F.when(F.col("_hash") <= F.col("_limit"), F.lit(None)).otherwise(F.col(column))).drop("_hash", "_limit")
    return hit.unionByName(df.where(F.col(column).isNull()))


def unit_change(df: DataFrame, column: str, factor: float, offset: float = 0.0) -> DataFrame:
    """All values in another unit; whole numbers are rounded half to even."""
    kind = df.schema[column].dataType
    value = F.col(column) * F.lit(factor) + F.lit(offset)
    return df.withColumn(column, (F.bround(value.cast("double")) if kind.typeName() in ("integer", "long", "short", "byte") else value).cast(kind))


def duplicates(df: DataFrame, keys: list[str], rate: float, seed: int = 0) -> DataFrame:
    more = _sampled(df, keys, rate, seed).where(F.col("_hash") <= F.col("_limit")).drop("_hash", "_limit")
    return df.unionByName(more)


def renamed_key(df: DataFrame, key: str, suffix: str = "_renamed") -> DataFrame:
    return df.withColumnRenamed(key, key + suffix)


def dropped_column(df: DataFrame, column: str) -> DataFrame:
    return df.drop(column)


def added_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lit(None).cast("string"))


def random_column(df: DataFrame, keys: list[str], seed: int, kept: tuple[str, ...] = ("run_id", "ingested_at")) -> str:
    """A column to hurt: neither a key nor one of bookkeeping; the same for a seed, whatever the columns' order."""
    free = sorted(set(df.columns) - set(keys) - set(kept))
    if not free:
        raise ValueError("all columns are keys or bookkeeping")
    return random.Random(seed).choice(free)


def schema_difference(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    return {"missing": sorted(set(columns) - set(df.columns)), "added": sorted(set(df.columns) - set(columns))}


def assert_safe(target: str, live: str) -> None:
    """A fault never goes into the live store."""
    if target.rstrip("/") == live.rstrip("/") or target.startswith(live.rstrip("/") + "/"):
        raise ValueError("faults go into a copy, never into the live store")
