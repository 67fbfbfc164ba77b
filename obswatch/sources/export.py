"""Summaries as CSV files whose bytes change only when their rows do.

Cells become text inside Spark; a file is made of the sorted lines of one small report, and is written through
the file system that Spark uses. A manifest beside the files keeps their digests and the version of the code, so
that what hasn't changed is not written again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "digests.json"


def short_float(values: Column) -> Column:
    """Six significant digits without needless zeros, as C's %g; Java's differs. In Arrow batches."""

    @F.arrow_udf(T.StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([None if x is None else f"{x:.6g}" for x in b.to_pylist()], pa.string())

    return text(values.cast("double"))


def cells(df: DataFrame) -> DataFrame:
    """Every column as text: nothing for null, true and false, six digits of a number with a point."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        known = short_float(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.cast("string")
        out.append(F.coalesce(known, F.lit("")).alias(f.name))
    return df.select(*out)


def _quoted(c: str) -> Column:
    x = F.col(f"`{c}`")
    return F.when(x.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)


def csv_text(df: DataFrame, order: list[str]) -> str:
    """The report as CSV, in an order that nulls end. Reports have some hundred rows, and come to the driver line by line."""
    ordered = df.withColumn("_at", F.struct(*(F.struct(F.col(c).isNull(), F.col(c)) for c in order)))
    text = cells(ordered.drop("_at")).columns
    lines = ordered.select("_at", *(F.col(c) for c in text))
    shown = lines.select("_at", F.struct(*(F.col(f"`{c}`") for c in text)).alias("row"))
    out = cells(shown.select("_at", "row.*").orderBy("_at").drop("_at")).select(F.concat_ws(",", *(_quoted(c) for c in text)).alias("line"))
    return "\n".join([",".join(text), *(r["line"] for r in out.toLocalIterator()), ""])


class Folder:
    """A folder of reports on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def known(self) -> dict[str, str]:
        """Digests by name, and the version of the code under an empty name; empty if there is no manifest, or a broken one."""
        if not self._fs.exists(self._at(f"{self.path}/{MANIFEST}")):
            return {}
        text = self.spark.read.text(f"{self.path}/{MANIFEST}", wholetext=True).first()
        try:
            return dict(json.loads(text[0])) if text else {}
        except (ValueError, TypeError):
            return {}

    def _put(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(f"{self.path}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()

    def publish(self, reports: dict[str, str], version: str, generated_at: str) -> list[str]:
        """Writes the reports that differ, and meta.csv if one did or the version did; the names of what was written."""
        before = self.known()
        now = {name: hashlib.sha256(text.encode()).hexdigest() for name, text in reports.items()}
        gone = [n for n in now if not self._fs.exists(self._at(f"{self.path}/{n}"))]
        changed = [n for n, d in now.items() if before.get(n) != d or n in gone]
        if not changed and before.get("") == version:
            return []
        for n in changed:
            self._put(n, reports[n])
        self._put("meta.csv", f"generated_at_utc,git_sha\n{generated_at},{version}\n")
        self._put(MANIFEST, json.dumps({**now, "": version}, sort_keys=True))
        return [*changed, "meta.csv"]
