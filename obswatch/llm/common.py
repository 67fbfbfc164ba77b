"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obswatch.functions import shipping

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts are handed to numpy in runs of about this many characters.
RUN_CHARS = 500_000


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, for clusters where it isn't installed, and bounds Arrow batches."""
    if spark.conf.get(BATCH_ROWS, None) is None:  # texts are long: ten thousand rows a batch are tens of megabytes
        spark.conf.set(BATCH_ROWS, "1000")
    shipping.ship(spark)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python sees Arrow batches of so many rows in what is run within."""
    was = spark.conf.get(BATCH_ROWS, None)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_ROWS) if was is None else spark.conf.set(BATCH_ROWS, was)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session
    (tests) gets a folder of its own; on a cluster that is an error, as executors couldn't read the driver's."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="shared_")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def apart(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """docs with the columns renamed that clash with the names, and what selects them under their own names."""
    new = {}
    for c in docs.columns:
        if c in names:
            other = f"own_{c}"
            while other in docs.columns or other in names or other in new.values():
                other = f"own_{other}"
            new[c] = other
    return docs.withColumnsRenamed(new), [F.col(f"`{new.get(c, c)}`").alias(c) for c in docs.columns]


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Deletes the files under a frame from written() that is not needed any more."""
    spark = df.sparkSession
    for path in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if "/table-" in path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Frames of ids are broadcast up to this many rows (some 100 bytes each); larger ones are joined by shuffling.
FEW = 200_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """df of so many rows, to be broadcast if they are few."""
    return F.broadcast(df) if rows <= FEW else df


#: Bits of a sieve: 8 MB, in maps of 32,768.
SIEVE_BITS = 1 << 26


def _sieve_place(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SIEVE_BITS)) + 1


def sieve(df: DataFrame, column: str) -> DataFrame:
    """Bitmaps (sieve_bucket, sieve_bits) of the hashes of a column: 8 MB, whatever the input."""
    places = df.select(_sieve_place(F.col(column)).alias("at")).select(F.bitmap_bucket_number("at").alias("sieve_bucket"), F.bitmap_bit_position("at").alias("bit"))
    return written(places.repartition("sieve_bucket").groupBy("sieve_bucket").agg(F.bitmap_construct_agg("bit").alias("sieve_bits")))


def sifted(df: DataFrame, column: str, by: DataFrame, through: bool = True) -> DataFrame:
    """The rows of df that may be among those of the sieve, or else those that surely aren't, without a shuffle.

    Before a semi-join by shuffling, so that few rows are shuffled; that join still decides. Where values fill
    the sieve, as some 100 million do, more rows go through and the result is the same.
    """
    bit = F.bitmap_bit_position("sieve_at")
    byte = F.conv(F.hex(F.substring("sieve_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0, F.lit(False))
    both = df.withColumn("sieve_at", _sieve_place(F.col(column))).withColumn("sieve_own", F.bitmap_bucket_number("sieve_at"))
    met = both.join(F.broadcast(by), F.col("sieve_own") == F.col("sieve_bucket"), "left")
    return met.where(hit if through else ~hit).select(*df.columns)


def id_hash(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def runs(texts: list[str | None], limit: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of successive runs of texts with about limit characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def append_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[list[str | None]], list[list]]]) -> DataFrame:
    """df with the fields appended that the function returned by make() (called once a task) gives for a list of texts.

    Columns of df that have a field's name are replaced. Python sees whole texts, in runs of bounded size.
    """
    names = [n for n, _ in fields]
    df = df.drop(*[c for c in df.columns if c in names])
    schema = T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in fields])
    arrow = [_arrow(t) for _, t in fields]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        fn = make()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in runs(values := column.to_pylist()):
                out = fn(values[a:b])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(v, type=t) for v, t in zip(out, arrow, strict=True))], names=[*part.schema.names, *names])

    return df.mapInArrow(task, schema)


#: What tasks keep for the next task of their worker, by name: calls that forget it.
MEMORIES: dict[str, Callable[[], None]] = {}


def settle(own: str | None = None) -> None:
    """Forgets what tasks of other kinds have kept, and gives freed memory back to the system."""
    for name, forget in MEMORIES.items():
        if name != own:
            forget()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def no_cycles() -> Iterator[None]:
    """Stops the search for cycles while millions of strings without any are made."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def quietly(task: Callable) -> Callable:
    """A task of mapInArrow that runs under no_cycles()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycles():
            yield from task(batches)

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b) with a < b: rows (node, root), root the smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until nothing changes; rounds grow
    with the logarithm of the longest path. Stars are formed by grouped minima and joins, so that no group of
    neighbours meets in one row. Of many edges, minima are written before they are joined: both sides of a join
    then come from files, and the leaves of one star are split among tasks. Each round is written too, and the
    last one dropped.
    """
    now = written(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    seen = _digest(now)
    while True:
        held = written if seen[0] > FEW else lambda df: df  # a step of few edges is one job
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = held(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = held(both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct())
        # small star: every node with its smaller neighbours and itself, tied to the smallest of them
        least = held(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")))
        small = large.join(least, large["b"] == least["u"]).select(F.col("m").alias("x"), F.col("a").alias("y")).union(least.select(F.col("m"), F.col("u")))
        after = written(small.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        for done in (now, low, large, least) if held is written else (now,):
            drop_written(done)
        now, before, seen = after, seen, _digest(after)
        if seen == before:
            break
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Successive groups of equal keys in batches that are sorted by them: the key and the columns' values."""
    key, held = None, None
    for batch in batches:
        data = batch.to_pydict()
        rows = list(zip(*(data[k] for k in keys), strict=True))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                if rows[start] != key:
                    if held is not None:
                        yield key, held
                    key, held = rows[start], {n: [] for n in data}
                for n, v in data.items():
                    held[n] += v[start:i]
                start = i
    if held is not None:
        yield key, held
