"""A day's run: stages one after the other, each on its own; what failed is named, the rest goes on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obswatch.operators import checks, state


def run_stages(stages: list[tuple[str, Callable[[], object]]]) -> dict[str, str | None]:
    """Each stage's error, or None."""
    out: dict[str, str | None] = {}
    for name, stage in stages:
        try:
            stage()
            out[name] = None
        except Exception as e:  # stages don't depend on each other's success
            out[name] = str(e)[:200]
    return out


def run_checks(builders: dict[tuple[str, str], Callable[[], DataFrame]], incidents: DataFrame, now) -> DataFrame:
    """Incidents after all checks. A check is a frame with a boolean failed; one that can't be built fails its
    source's schema check, and sources whose checks could all be built pass it."""
    spark = incidents.sparkSession
    frames, broken = [], set()
    for (source, name), build in builders.items():
        df, error = checks.guarded(source, name, build)
        if error:
            broken.add(source)
        else:
            frames.append(df.agg(F.count("*").alias("_n"), F.bool_or("failed").alias("failed")).where("_n > 0").select(F.lit(source).alias("source"), F.lit(name).alias("check_name"), "failed"))
    sources = sorted({s for s, _ in builders})
    verdicts = spark.createDataFrame([(s, "schema", s in broken) for s in sources], "source string, check_name string, failed boolean")
    for f in frames:
        verdicts = verdicts.unionByName(f)
    return state.settle(incidents, verdicts, now)
