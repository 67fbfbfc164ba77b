"""Tables with keys on plain Parquet: every write makes new version folders, and one manifest names them all.

A manifest is written under a new number in one rename, so that a reader sees all tables of a write or none,
and an older manifest is a snapshot. Only the driver commits; executors write Parquet to the folder given.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obswatch.operators import faults, series, state


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: str
    keys: tuple[str, ...]
    #: SQL over the keys that names the part of the table which has a row, such as year(obs_date): an upsert
    #: writes only the parts that its rows are in. There should be some hundred parts at most.
    part: str = ""

    def folder(self) -> Column:
        return F.regexp_replace(F.coalesce(F.expr(self.part).cast("string"), F.lit("null")), "[^A-Za-z0-9_.-]", "_")


class Store:
    """Keyed tables under a root that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str, tables: list[TableSpec]) -> None:
        self.spark, self.root, self.specs = spark, root.rstrip("/"), {t.name: t for t in tables}
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))

    def versions(self) -> list[int]:
        found = self._fs.listStatus(self._path(f"{self.root}/manifests"))
        names = [f.getPath().getName() for f in found]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict[str, dict[str, str]]:
        """Folders by table and part; a table without parts has one, without a name."""
        known = self.versions()
        if not known:
            return {}
        text = self.spark.read.text(f"{self.root}/manifests/{known[-1] if version is None else version:08d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The table as of a version; columns that its files lack are null, and a table never written is empty."""
        return self._parts(table, self.manifest(version).get(table, {}))

    def _parts(self, table: str, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.specs[table].schema)
        return self.spark.read.schema(self.specs[table].schema).parquet(*(f"{self.root}/{at}" for at in folders.values()))

    def _write(self, name: str, df: DataFrame) -> dict[str, str]:
        """Writes rows to a new folder; the folders of their parts."""
        spec, at = self.specs[name], f"{name}/{uuid.uuid4().hex}"
        rows = df.select(*self.spark.createDataFrame([], spec.schema).columns)
        if not spec.part:
            rows.write.parquet(f"{self.root}/{at}")
            return {"": at}
        rows.withColumn("_part", spec.folder()).write.partitionBy("_part").parquet(f"{self.root}/{at}")
        found = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.root}/{at}"))]
        return {n.removeprefix("_part="): f"{at}/{n}" for n in found if n.startswith("_part=")}

    def commit(self, tables: dict[str, DataFrame]) -> int:
        """Writes whole tables and then makes them current together."""
        return self._publish({n: self._write(n, df) for n, df in tables.items()})

    def _publish(self, written: dict[str, dict[str, str]]) -> int:
        now = self.manifest() | written
        number = (self.versions() or [0])[-1] + 1
        part, done = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}"), self._path(f"{self.root}/manifests/{number:08d}.json")
        out = self._fs.create(part)
        out.write(bytearray(json.dumps(now, sort_keys=True).encode()))
        out.close()
        if not self._fs.rename(part, done):
            raise RuntimeError("another writer committed first")
        return number

    def upsert(self, batches: dict[str, DataFrame]) -> int:
        """Rows replace stored rows of their key, the last of a batch first; all tables or none. Of a table in
        parts, only the parts that have a key of the batch are read and written."""
        written, now = {}, self.manifest()
        for name, rows in batches.items():
            spec, keys, known = self.specs[name], list(self.specs[name].keys), now.get(name, {})
            rows = rows.withColumn("_o", F.monotonically_increasing_id())
            if spec.part:
                touched = {r[0] for r in rows.select(spec.folder()).distinct().collect()}
            else:
                touched = set(known)
            stored = self._parts(name, {p: at for p, at in known.items() if p in touched})
            merged = state.upsert(stored, series.last_wins(rows, keys, "_o").drop("_o"), keys)
            written[name] = {**{p: at for p, at in known.items() if p not in touched}, **self._write(name, merged)}
        return self._publish(written)

    def ingest(self, run_table: str, raw_table: str, run: dict, payload: str | None, parse: Callable[[DataFrame], dict[str, DataFrame]]) -> str:
        """One run: payload and parsed rows with the run's row, or, if anything fails, payload and a failed run.

        Rows are stamped with run_id and ingested_at; the run's row has its times and the payload's digest."""
        started = dt.datetime.now(dt.timezone.utc)
        digest = None if payload is None else hashlib.sha256(payload.encode("utf-8", "surrogatepass")).hexdigest()
        raw = self.spark.createDataFrame([(run["run_id"], payload, digest)], "run_id string, payload string, payload_sha256 string")
        try:
            stamp = {"run_id": F.lit(run["run_id"]), "ingested_at": F.lit(started)}
            stamped = {n: df.withColumns(stamp) for n, df in parse(raw.drop("payload_sha256")).items()}
            self.upsert({raw_table: raw, **stamped, run_table: self._run(run, "succeeded", started, digest)})
            return "succeeded"
        except Exception as e:  # the failure is part of the log; fetched raises it for those who ask for the run
            self.upsert({raw_table: raw, run_table: self._run(run, "failed", started, digest, str(e)[:2000])})
            return "failed"

    def _run(self, run: dict, status: str, started: dt.datetime, digest: str | None = None, error: str | None = None) -> DataFrame:
        row = (run["run_id"], run["source"], status, error, started, dt.datetime.now(dt.timezone.utc), digest)
        return self.spark.createDataFrame([row], "run_id string, source string, status string, error string, started_at timestamp, finished_at timestamp, payload_sha256 string")

    def fetched(self, run_table: str, raw_table: str, run: dict, fetch: Callable[[], str | None], parse: Callable[[DataFrame], dict[str, DataFrame]]) -> None:
        """Fetches and ingests. A fetch that fails is logged as a failed run and raised again; a failed run is raised once it is logged."""
        started = dt.datetime.now(dt.timezone.utc)
        try:
            payload = fetch()
        except Exception as e:
            self.upsert({run_table: self._run(run, "failed", started, error=str(e)[:2000])})
            raise
        if self.ingest(run_table, raw_table, run, payload, parse) == "failed":
            raise RuntimeError(f"run {run['run_id']} of {run['source']} failed")

    def copy_to(self, root: str, version: int | None = None) -> Store:
        """A store of its own with all tables as of a version, such as one to inject faults into."""
        faults.assert_safe(root, self.root)
        other = Store(self.spark, root, list(self.specs.values()))
        other.commit({n: self.read(n, version) for n in self.manifest(version)})
        return other

    def backup(self, path: str) -> list[str]:
        """Each table as CSV with a header, its rows in the order of all its columns, nulls last; a folder a table."""
        names = sorted(self.manifest())
        for n in names:
            df = self.read(n)
            df.orderBy(*(F.col(c).asc_nulls_last() for c in df.columns)).write.option("header", True).csv(f"{path.rstrip('/')}/{n}")
        return names

    def prune(self, keep: int = 8) -> list[int]:
        """Forgets all but the newest manifests, and the folders that only they name."""
        known = self.versions()
        old, new = known[:-keep], known[-keep:]
        folders = lambda v: [at for parts in self.manifest(v).values() for at in parts.values()]
        used = {at for v in new for at in folders(v)}
        for v in old:
            for at in folders(v):
                if at not in used:
                    self._fs.delete(self._path(f"{self.root}/{at}"), True)
            self._fs.delete(self._path(f"{self.root}/manifests/{v:08d}.json"), False)
        return old
