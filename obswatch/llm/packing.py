"""Packing of tokenised documents into sequences, as a cutting-stock problem.

A document's ids, with the end id, are cut into full sequences; what remains is cut once more, into a
multiple of ``grain`` and a tail shorter than that. The lengths of these pieces then come from a fixed
set, whatever the input, and their histogram is all that the driver sees. A linear program over packing
patterns covers it with the fewest sequences: starting from patterns of one length each, knapsack dynamic
programming on the dual prices finds columns that improve it until there is none. Multiplicities are
rounded down; what is left over (a bounded number of pieces) is filled greedily, largest piece first.

Pieces are ranked by length: each task numbers its own pieces of a length while it tokenises, and sums of
the tasks' counts shift these numbers. A pattern takes a range of ranks of each of its lengths, so that a
piece finds its sequence and offset by arithmetic. No rows are sorted and no group of pieces meets in one
task, however many share a length.

Defined results: a null or empty text has the end id only; a null id and repeated rows are packed like
any other; an empty table gives no pieces. Copies are packed one by one.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.llm.common import MEMORIES, few, quietly, runs, settle, ship, table, written

SIZE, GRAIN, END = 2048, 64, 1
#: Parts of texts that a worker remembers, some 250 bytes each; texts are taken in runs of three times so many characters.
REMEMBERED = 700_000
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: Signs that the tokenizer parts from letters before them.
_SIGNS = ".,;:!?%*&$#|<>=+-/()[]{}\"_~^@\\"


def _lowered(text: str) -> str:
    """text in lower case, if its characters are those whose lower case is the same by any rule, and none
    could be of a special token, which is looked for as written."""
    if "<|" in text:
        return text
    if text.isascii():
        return text.lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class Encoder:
    """Ids as little-endian bytes.

    The tokenizer treats parts between blanks on their own, and letters and the signs after them too, and
    lower-cases. So a part's ids are looked up when it, or else its letters and its signs, have been seen;
    new runs of letters are given to the tokenizer in one text, which the ends of words divide. The
    memory of parts is bounded: the older half of it goes.
    """

    def __init__(self, path: str, limit: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for piece, i in self.tokenizer.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")

    def _plain(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        for a in range(0, len(parts), 5000):
            some = parts[a : a + 5000]
            for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                yield p, np.array(e.ids, "<u4").tobytes()

    def _letters(self, runs_of_letters: list[str]) -> Iterator[tuple[str, bytes]]:
        for a in range(0, len(runs_of_letters), 2000):
            some = runs_of_letters[a : a + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) != len(some):
                yield from self._plain(some)
                continue
            data, at = ids.tobytes(), (4 * at).tolist()
            yield from zip(some, (data[x:y] for x, y in zip([0, *at], at, strict=False)), strict=True)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        parts = [_lowered(t or "").replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > self.limit:
            self.before, self.known = self.known, {"": b""}
        known, before = self.known, self.before
        new = set().union(*parts).difference(known)
        again = {p for p in new if p in before}
        known.update((p, before[p]) for p in again)
        simple: list[tuple[str, str, str]] = []
        odd: set[str] = set()
        letters: set[str] = set()
        for p in new.difference(again):
            w = p.rstrip(_SIGNS)
            if w.isalpha() and (w.isascii() or max(w) < "\u0100"):
                if w is p or len(w) == len(p):
                    letters.add(p)
                    continue
                simple.append((p, w, p[len(w) :]))
                if w not in known:
                    letters.add(w)
                if simple[-1][2] not in known:
                    odd.add(simple[-1][2])
            else:
                odd.add(p)
        known.update(self._plain(list(odd)))
        known.update(self._letters(list(letters.difference(odd))))
        for p, w, signs in simple:
            known[p] = known[w] + known[signs]
        return [b"".join(map(known.__getitem__, p)) for p in parts]


@functools.lru_cache(1)
def encoder(path: str, limit: int) -> Encoder:
    """One encoder for all tasks of a worker, which so starts with the parts of earlier ones."""
    return Encoder(path, limit)


MEMORIES["packing"] = encoder.cache_clear


def cuts(tokens: int, size: int = SIZE, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of so many tokens."""
    full, rest = divmod(tokens, size)
    main = rest // grain * grain
    return [size] * full + [x for x in (main, rest - main) if x]


def pieces(docs: DataFrame, key: str, text: str, path: str, size: int = SIZE, grain: int = GRAIN, end: int = END, remembered: int = REMEMBERED) -> DataFrame:
    """A row for each piece; k counts the pieces of one length in one task, part is that task."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "k"]
    last = np.array([end], "<u4").tobytes()

    @quietly  # strings and bytes by the million
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle("packing")
        encode, part, counts = encoder(path, remembered), TaskContext.get().partitionId(), {}
        for b in batches:
            texts = b.column(1).to_pylist()
            for x, y in runs(texts, 3 * remembered):
                at, out = [], [[] for _ in range(5)]
                for i, ids in enumerate(encode(texts[x:y])):
                    data = memoryview(ids + last)
                    total, start = len(data) // 4, 0
                    for n in cuts(total, size, grain):
                        k = counts.get(n, 0)
                        counts[n] = k + 1
                        at.append(x + i)
                        for column, v in zip(out, (start, n, zlib.crc32(data[4 * start : 4 * (start + n)]), total, k), strict=True):
                            column.append(v)
                        start += n
                start, n, crc, total, k = (pa.array(c, pa.int64()) for c in out)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), start, n, crc, total, pa.array([part] * len(at), pa.int32()), k], names=names)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(task, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part int, k long")


def best_pattern(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the largest price that fits, by dynamic programming."""
    value, pick = np.zeros(size + 1), np.full(size + 1, -1)
    for c in range(1, size + 1):
        value[c] = value[c - 1]
        n = int(np.searchsorted(lengths, c, side="right"))
        if n:
            got = value[c - lengths[:n]] + prices[:n]
            i = int(np.argmax(got))
            if got[i] > value[c] + 1e-12:
                value[c], pick[c] = got[i], i
    pattern, c = np.zeros(len(lengths)), size
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= lengths[pick[c]]
    return float(value[size]), pattern


def solve(lengths: np.ndarray, demand: np.ndarray, size: int, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Column generation by the revised simplex method: the basis' patterns and their multiplicities.

    It ends at the optimum, or as soon as the bound that the best pattern's worth gives leaves less than one
    sequence to save; rounds guard against endless steps without gain, and a cover is feasible all the same.
    """
    basis = np.diag((size // lengths).astype(float))
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(lengths)))
        worth, pattern = best_pattern(lengths, prices, size)
        x, d = np.linalg.solve(basis, demand), np.linalg.solve(basis, pattern)
        if worth <= 1 + 1e-7 or x.sum() - x.sum() / worth < 0.5:
            break
        ratio = np.where(d > 1e-9, np.maximum(x, 0) / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = pattern
    return basis, np.maximum(np.linalg.solve(basis, demand), 0)


def plan(lengths: list[int], demand: list[int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """Patterns (count by length) and how many sequences follow each; every piece is covered exactly."""
    if not lengths:
        return []
    order = np.argsort(lengths)
    ls, left = np.array(lengths)[order], np.array(demand, np.int64)[order]
    basis, x = solve(ls, left.astype(float), size)
    out: list[tuple[dict[int, int], int]] = []
    for j in np.argsort(-x, kind="stable"):
        a = np.rint(basis[:, j]).astype(np.int64)
        n = int(x[j] + 1e-6)
        used = a > 0
        n = min(n, int((left[used] // a[used]).min())) if used.any() else 0
        if n > 0:
            left = left - n * a
            out.append(({int(ls[i]): int(a[i]) for i in np.flatnonzero(a)}, n))
    while left.any():
        room, a = size, np.zeros(len(ls), np.int64)
        for i in range(len(ls) - 1, -1, -1):
            a[i] = min(left[i], room // ls[i])
            room -= int(a[i] * ls[i])
        n = int((left[a > 0] // a[a > 0]).min())
        left = left - n * a
        out.append(({int(ls[i]): int(a[i]) for i in np.flatnonzero(a)}, n))
    return out


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, size: int = SIZE, grain: int = GRAIN, end: int = END, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut = written(pieces(docs, key, text, path or tokenizer_path(), size, grain, end, remembered))
    counts = written(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # size/grain + grain lengths at most
    shifts = counts.withColumn("shift", F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")).drop("n")
    ranked = cut.join(few(shifts, counts.count()), ["length", "part"]).withColumn("rank", F.col("k") + F.col("shift"))
    lengths = sorted(n for n in totals if n != size)
    places, first = [], 0
    taken = dict.fromkeys(lengths, 0)
    for pattern, times in plan(lengths, [totals[n] for n in lengths], size):
        offset = 0
        for n, a in sorted(pattern.items(), reverse=True):
            places.append((n, taken[n], taken[n] + a * times, a, first, offset))
            taken[n] += a * times
            offset += n * a
        first += times
    places += [(size, 0, totals.get(size, 0), 1, first, 0)]
    held = spark.createDataFrame(places, "of long, low long, high long, per long, first long, at long")
    j = F.col("rank") - F.col("low")
    found = ranked.join(F.broadcast(held), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.floor(j / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + (j % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, copies and repeated rows one by one; a null or empty text is one end id, an
    empty table gives no pieces, and columns but doc_id and text aren't looked at."""
    ship(spark)
    return pack(docs.select("doc_id", "text"), remembered=300_000)  # the executors still hold what earlier stages left
