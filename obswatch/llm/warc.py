"""WARC archives, compressed record by record with a Zstandard dictionary.

Pages with equal payloads are stored once: the one with the smallest id is a response record, the others
are revisit records that refer to it. Each task gathers records up to ``archive_bytes``, builds a
dictionary from a spread of them, and makes one archive: a skippable frame (magic 0x184D2A5D) that holds
the dictionary, then a Zstandard frame for each record. An archive is one row (name, content), so that the
store that Spark writes to holds them whole; files() puts them into files of their own.

Defined results: a null payload is empty; a null url becomes one made of the id; a page with a null id is
always a response, and so are rows that repeat the smallest id; payloads under ``min_bytes`` are all
responses. Other columns are not archived. An empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obswatch.llm.common import few, table, written

DICT_MAGIC = 0x184D2A5D
ARCHIVE_BYTES, DICT_BYTES, SAMPLE_BYTES, LEVEL = 8 << 20, 16 << 10, 1 << 20, 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header and leaves out the payload."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:x-page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    size = int(head["content-length"])
    if data[end + 4 + size :] != b"\r\n\r\n":
        raise ValueError("a record of another length")
    return head, data[end + 4 : end + 4 + size]


def dictionary(records: list[bytes]) -> zstd.ZstdCompressionDict | None:
    """From a spread of the records of an archive; too few to train on are the dictionary themselves."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    some = [r[: 128 << 10] for r in records[::step]]
    if not some:
        return None
    try:
        return zstd.train_dictionary(DICT_BYTES, some, k=256, d=8)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(some)[-DICT_BYTES:], dict_type=zstd.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    held = dictionary(records)
    out = []
    if held is not None:
        packed = zstd.ZstdCompressor(level=LEVEL).compress(held.as_bytes())
        out.append(struct.pack("<II", DICT_MAGIC, len(packed)) + packed)
        held.precompute_compress(level=LEVEL)
    pack = zstd.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True, write_content_size=True)
    return b"".join(out + [pack.compress(r) for r in records])


def _frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame that starts at a place ends."""
    head = data[at : at + 18]
    checksum = zstd.get_frame_parameters(head).has_checksum
    at += zstd.frame_header_size(head)
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * checksum


def read(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive."""
    at, held = 0, None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICT_MAGIC:
        size = struct.unpack_from("<I", content, 4)[0]
        raw = zstd.ZstdDecompressor().decompress(content[8 : 8 + size])
        held = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_AUTO)
        at = 8 + size
    unpack = zstd.ZstdDecompressor(dict_data=held) if held is not None else zstd.ZstdDecompressor()
    while at < len(content):
        end = _frame_end(content, at)
        yield parse(unpack.decompress(content[at:end]))
        at = end


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """key, sha1 and refers_to of each page whose payload a page with a smaller id has; narrow rows only."""
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    narrow = pages.where(F.octet_length(data) >= min_bytes).select(F.col(key).alias("key"), F.sha1(data).alias("sha1"))
    first = narrow.groupBy("sha1").agg(F.min("key").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return narrow.join(first, "sha1").where("key > refers_to").distinct()


def archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """name and content of the archives of all pages."""
    again = written(revisits(pages, key, payload, min_bytes))
    again = few(again, again.count())
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = rows.join(again, (rows["k"] == again["key"]) & (F.sha1(rows["payload"].cast("binary")) == again["sha1"]), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = made = 0

        def flush() -> pa.RecordBatch:
            name = f"pages-{TaskContext.get().partitionId():06d}-{made:05d}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([archive(held)], pa.binary())], names=["name", "content"])

        for b in batches:
            for k, u, p, r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(record(k or "null", u, p.encode("utf-8", "surrogatepass"), r))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size, made = [], 0, made + 1
        if held:
            yield flush()

    return rows.select(F.col("k").cast("string"), "url", "payload", F.col("refers_to").cast("string")).mapInArrow(task, "name string, content binary")


def records(found: DataFrame, kind: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of all records of archives.

    A response's payload is measured; a revisit says in its headers what its payload was.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                out: list[tuple] = []
                for head, block in read(content.as_py()):
                    cut = block.index(b"\r\n\r\n") + 4
                    named = head["warc-payload-digest"].removeprefix("sha1:")
                    size = int(re.search(rb"Content-Length: (\d+)", block[:cut])[1])
                    if head["warc-type"] == "response" and (len(block) - cut != size or digest(block[cut:]) != named):
                        raise ValueError("a payload of another digest")
                    name, to = head["warc-record-id"][12:-1], head.get("warc-refers-to")
                    out.append((None if name == "null" else name, size, named, head["warc-type"], to and to[12:-1]))
                if out:
                    ids, sizes, sums, types, refs = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int64()), pa.array(sums, pa.string()), pa.array(types, pa.string()), pa.array(refs, pa.string())], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    rows = found.select("content").mapInArrow(task, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def files(found: DataFrame, folder: str) -> list[str]:
    """Writes each archive to a file of its own, one at a time; for an export of some archives to a local folder."""
    paths = []
    for row in found.toLocalIterator():
        with open(f"{folder}/{row['name']}", "wb") as f:
            f.write(row["content"])
        paths.append(f"{folder}/{row['name']}")
    return paths


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return records(written(archives(pages)))


#: Base32 by way of the 160 bits of the SHA-1.
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
s AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(encode(body)) AS hex FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111',
    (4 * (strpos('0123456789abcdef', substr(hex, i::BIGINT, 1)) - 1) + 1)::BIGINT, 4)), '') AS bits
  FROM s),
d AS (
  SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1
      + 16 * substr(bits, (5 * i + 1)::BIGINT, 1)::INT + 8 * substr(bits, (5 * i + 2)::BIGINT, 1)::INT
      + 4 * substr(bits, (5 * i + 3)::BIGINT, 1)::INT + 2 * substr(bits, (5 * i + 4)::BIGINT, 1)::INT
      + substr(bits, (5 * i + 5)::BIGINT, 1)::INT)::BIGINT, 1)), '') AS payload_digest
  FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""
