"""Sharding by extendible hashing, in DataFrame operations only.

The hash of a row is the first 60 bits of the md5 of its id as text. The directory starts as one bucket;
a bucket over the byte limit is split on another bit, again and again, and buckets that fit are shards, so
that several directory slots may lead to one shard. Sizes are summed once for slots of a depth that follows
from the total size; a round splits the buckets that are still too large by up to STEP bits, adding up the
slots below them alone. Buckets that are over the limit at that depth (large documents, repeated ids) are
split further, over their own rows. Rows that share all 60 bits can't be told apart by hash: past the limit
they are dealt to overflow shards in the order of their size and text, as many to a shard as always fit.

Defined results: a null text has 0 bytes, a null id the hash of an empty text; a single document over the
limit is a shard of its own (or shares 60 bits and overflows to one row a shard); an empty table gives no
rows; repeated rows are separate rows; the shards don't depend on how the rows are dealt. Only the id and
the text are used, and other columns travel in one of their own, so that they never clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.llm.common import table, written

BITS = 60
#: Bytes of text in a shard at most.
LIMIT = 1 << 20
#: Directory slots for each shard's worth of bytes, as a power of two; bits that a round may add.
SPARE, STEP = 4, 6


def _cut(depth: int, of: int = BITS, column: str = "hash") -> Column:
    """The first bits of a prefix of so many bits."""
    return F.shiftright(column, of - depth)


def split(slots: DataFrame, depth: int, limit: int, low: int = 0) -> DataFrame:
    """Shards from slots (hash, bytes, docs), hash being a prefix of depth bits: (slot, depth, prefix, bytes,
    docs), for every slot in a shard; slots of buckets that are over the limit at this depth are left out.
    All buckets of low bits are known to be too large, or low is 0."""
    found, left = None, slots
    start = low
    while start <= depth:
        end = min(depth, start + STEP - 1)
        near = left.groupBy(_cut(end, depth).alias("at")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        steps = near.select("at", "bytes", "docs", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(at, {end} - depth)"))
        fit = steps.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")).where(F.col("bytes") <= limit)
        best = steps.select("at", "depth", "prefix").join(fit, ["depth", "prefix"]).groupBy("at").agg(F.min(F.struct("depth", "prefix", "bytes", "docs")).alias("leaf"))
        best = written(best.select("at", "leaf.*"))
        mine = left.select(F.col("hash").alias("slot"), _cut(end, depth).alias("at")).join(best, "at").drop("at")
        found = mine if found is None else found.unionByName(mine)
        left = left.withColumn("at", _cut(end, depth)).join(best.select("at"), "at", "left_anti").drop("at")
        start = end + 1
        if start <= depth:
            left = written(left)
            if left.isEmpty():
                break
    return found


def assigned(rows: DataFrame, limit: int, spare: int = SPARE) -> DataFrame:
    """rows (hash, n_bytes, mark: a hash of the text, and others) with depth, prefix, overflow, shard_id, shard_bytes and shard_docs."""
    sizes = rows.select("hash", "n_bytes", "mark")
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS - 1, max(0, math.ceil(math.log2(max(1, total / limit))) + spare))
    slots = written(sizes.groupBy(_cut(depth).alias("hash")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")))
    placed = written(split(slots, depth, limit))
    over = slots.join(placed.select(F.col("slot").alias("hash")), "hash", "left_anti").select(F.col("hash").alias("slot"))
    none = F.lit(0).cast("long").alias("overflow")
    out = rows.withColumn("slot", _cut(depth)).join(placed, "slot").drop("slot").select("*", none)
    if not over.isEmpty():
        large = rows.withColumn("slot", _cut(depth)).join(over, "slot", "left_semi").drop("slot")
        each = written(sizes.withColumn("slot", _cut(depth)).join(over, "slot", "left_semi").groupBy("hash").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"), F.max("n_bytes").alias("largest")))
        deeper = written(split(each.select("hash", "bytes", "docs"), BITS, limit, depth + 1))
        out = out.unionByName(large.join(deeper.withColumnRenamed("slot", "hash"), "hash").select("*", none).select(out.columns))
        full = each.where(F.col("bytes") > limit).select("hash", F.greatest(F.lit(1), F.floor(limit / F.col("largest"))).cast("long").alias("per"))
        out = out.unionByName(_overflow(large, full).select(out.columns))
    shard = F.concat_ws(".", F.col("depth").cast("string"), F.col("prefix").cast("string"), F.col("overflow").cast("string"))
    return out.withColumn("shard_id", shard).withColumn("depth", F.col("depth").cast("int")).withColumnsRenamed({"bytes": "shard_bytes", "docs": "shard_docs"})


def _overflow(rows: DataFrame, full: DataFrame) -> DataFrame:
    """rows of hashes over the limit, dealt to chunks of per rows by size, mark and, among equals, as they come.

    Ranks are sums of counts: of groups of marks, of marks within a group, of the reading tasks' rows within a
    mark, so that no task orders all rows of a hash.
    """
    mine = rows.join(full, "hash").withColumn("_group", F.pmod("mark", F.lit(4096))).withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    mine = written(mine)

    def before(keys: list[str], order: list[str], name: str) -> DataFrame:
        n = mine.groupBy(*keys, *order).agg(F.count("*").alias("n"))
        return n.withColumn(name, F.sum("n").over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")).drop("n")

    ranked = mine.join(before(["hash"], ["_group"], "_a"), ["hash", "_group"])
    ranked = ranked.join(before(["hash", "_group"], ["n_bytes", "mark"], "_b"), ["hash", "_group", "n_bytes", "mark"])
    ranked = ranked.join(before(["hash", "_group", "n_bytes", "mark"], ["_part"], "_c"), ["hash", "_group", "n_bytes", "mark", "_part"])
    within = F.row_number().over(W.partitionBy("hash", "_group", "n_bytes", "mark", "_part").orderBy("_seq")) - 1
    dealt = ranked.withColumn("_d", within).withColumn("overflow", F.floor((F.col("_a") + F.col("_b") + F.col("_c") + F.col("_d")) / F.col("per")).cast("long"))
    chunks = dealt.groupBy("hash", "overflow").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
    return dealt.join(chunks, ["hash", "overflow"]).withColumn("depth", F.lit(BITS)).withColumn("prefix", F.col("hash"))


def _rows(docs: DataFrame, key: str, text: str, others: list[Column]) -> DataFrame:
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    hashed = F.conv(F.substring(F.md5(name.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.select(*others, F.col(key).alias("doc_id"), size.alias("n_bytes"), hashed.alias("hash"), F.xxhash64(text).alias("mark"))


_OUT = ["doc_id", "n_bytes", "depth", "prefix", "overflow", "shard_id", "shard_bytes", "shard_docs"]


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, spare: int = SPARE) -> DataFrame:
    """doc_id, n_bytes, depth, prefix, overflow, shard_id, shard_bytes and shard_docs of every row."""
    return assigned(written(_rows(docs, key, text, [])), limit, spare).select(_OUT)


def directory(shards: DataFrame) -> DataFrame:
    """The directory of an assignment, a row a shard: global_depth (bits of an index), the first and last index
    that lead to the shard, and the shard; several where all bits couldn't split a hash. Indexes without rows are left out."""
    depth = shards.agg(F.max("depth").alias("global_depth"))
    each = shards.select("depth", "prefix", "shard_id").distinct().join(F.broadcast(depth))  # one row
    first = F.expr("shiftleft(prefix, global_depth - depth)")
    return each.select("global_depth", first.alias("first"), (first + F.expr("shiftleft(1L, global_depth - depth)") - 1).alias("last"), "shard_id")


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Writes docs to a folder for each shard, named shard=<shard_id>; returns the assignment.

    Every row is assigned itself, so that ids may repeat; a column of the name shard is written as own_shard.
    """
    packed = assigned(_rows(docs, key, text, [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")]), limit)
    flat = [F.col(f"row.`{c}`").alias("own_shard" if c == "shard" else c) for c in docs.columns]
    done = written(packed)
    done.select(F.col("shard_id").alias("shard"), *flat).repartition("shard").write.partitionBy("shard").parquet(path)
    return done.select(_OUT)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, 1 MiB of text at most in each."""
    return assign(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = f"""
WITH sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents),
steps AS (SELECT doc_id, n_bytes, hash, d AS depth, hash >> ({BITS} - d) AS prefix FROM sized, range(0, {BITS + 1}) AS r(d)),
nodes AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_docs FROM steps GROUP BY ALL HAVING sum(n_bytes) <= {LIMIT}),
leaves AS (
  SELECT s.doc_id, s.n_bytes, s.depth, s.prefix, n.shard_bytes, n.shard_docs,
         row_number() OVER (PARTITION BY s.doc_id ORDER BY s.depth) AS r
  FROM steps s JOIN nodes n USING (depth, prefix))
SELECT doc_id, n_bytes, depth::INT AS depth, prefix, 0::BIGINT AS overflow,
       depth || '.' || prefix || '.0' AS shard_id, shard_bytes, shard_docs
FROM leaves WHERE r = 1
"""
