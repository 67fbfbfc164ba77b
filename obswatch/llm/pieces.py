"""SentencePiece encoding with seeded merge-dropout, and decoding.

Symbols of a text are merged pair by pair, the pair with the best score first and the leftmost of equals,
as the BPE of a SentencePiece model does it. With a dropout, each merge that comes up is skipped if a hash
of the seed, the document, the chunk, its number in the document and the merge's place says so: the same
seed gives the same segmentation, another seed another one, and each occurrence of a chunk has draws of its
own. Without dropout the ids are those of the sentencepiece library.

Chunks are remembered without dropout, with the merges that came up. An occurrence of which none of those
is skipped has the same ids. For others, the first merge that is skipped leads to a branch: the chunk merged
without that place, remembered in the same way, on which the occurrence's draws go on. Branches that one
occurrence alone asks for, and those of long chunks, are merged for that occurrence by its draws; the ids are
the same by either way.

No piece of the model has a blank after another character or holds a line break, so that texts fall into
chunks which merges never cross. Short chunks are merged many at once, one merge of each in a step; long
ones by a heap and a linked list. Decoding joins the bytes of the pieces and is exact for every text: a
blank sign (U+2581) of the text itself is written as bytes.

Defined results: a null or empty text has no pieces and decodes to an empty text; equal ids and texts give
equal pieces; an empty table gives no rows. Input columns named as an output are replaced.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obswatch.llm.common import quietly, runs, table

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
DROPOUT, SEED = 0.1, 17
#: Characters of a long chunk; chunks remembered.
LONG, KNOWN = 48, 400_000
_CHUNK = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
_NONE = np.int32(2**31 - 1)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Model:
    """The pieces of a SentencePiece BPE model, and which pairs merge to which, in what order."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        normal = [i for i in range(self.size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.text = [sp.id_to_piece(i) for i in range(self.size)]
        self.id = {self.text[i]: i for i in normal}
        self.byte = {int(self.text[i][3:-1], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.bytes = [b""] * self.size
        for i in normal:
            self.bytes[i] = self.text[i].replace(BLANK, " ").encode()
        for b, i in self.byte.items():
            self.bytes[i] = bytes([b])
        if any(re.search(f"[^{BLANK}]{BLANK}|\n", t) for t in self.id):
            raise ValueError("pieces of this model cross blanks")
        self.char = np.full(0x110000, self.size, np.int32)
        for t, i in self.id.items():
            if len(t) == 1:
                self.char[ord(t)] = i
        order = np.full(self.size + 1, _NONE)
        for r, i in enumerate(sorted(normal, key=lambda i: -sp.get_score(i))):
            order[i] = r
        pairs = {}
        for t, i in self.id.items():
            for c in range(1, len(t)):
                a, b = self.id.get(t[:c]), self.id.get(t[c:])
                if a is not None and b is not None:
                    pairs[int(self._pair(np.int64(a), np.int64(b)))] = i
        bits = max(4, len(pairs).bit_length() + 3)
        self.shift, self.keys = np.uint64(64 - bits), np.full((1 << bits) + 64, -1, np.int64)
        self.merged = np.full((1 << bits) + 64, self.size, np.int32)
        self.probes = 1
        for k, i in pairs.items():
            h = (k * 0x9E3779B97F4A7C15 & (2**64 - 1)) >> int(self.shift)
            n = 1
            while self.keys[h] >= 0:
                h, n = h + 1, n + 1
            self.keys[h], self.merged[h], self.probes = k, i, max(self.probes, n)
        self.order = order

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A number for a pair of symbols from -2 to the model's size."""
        return (a.astype(np.int64) + 2) * (self.size + 3) + (b + 2)

    def merge(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs of symbols merge to, and the rank of that; symbols under 0 or of the model's size never merge."""
        key = self._pair(a, b)
        h = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)
        there = self.keys[h]
        hit = there == key
        out = np.where(hit, self.merged[h], np.int32(self.size))
        todo = np.flatnonzero((there >= 0) & ~hit)
        for _ in range(1, self.probes):
            if not len(todo):
                break
            h[todo] += 1
            there = self.keys[h[todo]]
            hit = there == key[todo]
            out[todo[hit]] = self.merged[h[todo[hit]]]
            todo = todo[(there >= 0) & ~hit]
        return out, self.order[out]


@functools.lru_cache(4)
def model(path: str) -> Model:
    return Model(path)


def _dropped(key: np.ndarray, start: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the merge of the symbols from start to end is skipped, by the chunk's key."""
    h = _mix(key ^ _mix(start.astype(np.uint64) * _A + end.astype(np.uint64) * _B))
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


def _place(chunk: np.ndarray | int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for a place in a chunk of up to LONG characters."""
    return (chunk * 64 + start) * 64 + end


def _crcs(chunks: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(c.encode("utf-8", "surrogatepass")) for c in chunks), np.uint64, len(chunks))


def _keyed(crcs: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    return _mix(crcs * _A + occurrences)


def _keys(seed: int, occurrence: int, chunks: list[str]) -> np.ndarray:
    """The keys of chunks, from which their merges' hashes come."""
    return _keyed(_crcs(chunks), np.uint64((seed * 64 + occurrence) & (2**64 - 1)))


def _occurrences(seed: int, keys: list[int], sizes: list[int]) -> np.ndarray:
    """A number for each chunk of documents in a row, by seed, document and the chunk's number in it."""
    docs = np.array([(k * 0x9E3779B97F4A7C15 + seed) & (2**64 - 1) for k in keys], np.uint64)
    starts = np.cumsum([0, *sizes])
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)
    return _mix(np.repeat(_mix(docs), sizes) + place.astype(np.uint64))


def _written(m: Model, symbols: list[int], chunk: str, starts: list[int]) -> bytes:
    """Ids of symbols; a character that the model lacks is written as its bytes."""
    if m.size not in symbols:
        return np.array(symbols, "<u4").tobytes()
    out: list[int] = []
    for s, a in zip(symbols, starts, strict=True):
        out += [s] if s != m.size else [m.byte[b] for b in chunk[a].encode("utf-8", "surrogatepass")]
    return np.array(out, "<u4").tobytes()


def _long(m: Model, chunk: str, key: int, dropout: float, made: list | None = None) -> bytes:
    """One chunk, by an agenda of candidate merges; made takes the starts and ends of its merges."""
    sym = [m.id.get(c, m.size) for c in chunk]
    left, right, end = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1], list(range(1, len(sym) + 1))
    agenda: list[tuple[int, int, int, int]] = []
    if len(sym) > 1:
        got, rank = m.merge(np.array(sym[:-1]), np.array(sym[1:]))
        agenda = [(int(r), i, i + 2, int(g)) for i, (g, r) in enumerate(zip(got, rank, strict=True)) if r != _NONE]
    heapq.heapify(agenda)
    k = np.array([key], np.uint64)

    def offer(i: int) -> None:
        j = right[i]
        if j >= 0:
            got, rank = m.merge(np.array([sym[i]]), np.array([sym[j]]))
            if rank[0] != _NONE:
                heapq.heappush(agenda, (int(rank[0]), i, end[j], int(got[0])))

    gone = [False] * len(sym)
    while agenda:
        rank, i, to, got = heapq.heappop(agenda)
        j = -1 if gone[i] else right[i]
        if j < 0 or end[j] != to:
            continue
        now, _ = m.merge(np.array([sym[i]]), np.array([sym[j]]))
        if int(now[0]) != got or (dropout and _dropped(k, np.array([i]), np.array([to]), dropout)[0]):
            continue
        if made is not None:
            made.append((i, to))
        sym[i], end[i], gone[j], right[i] = got, to, True, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    starts = [i for i in range(len(sym)) if not gone[i]]
    return _written(m, [sym[i] for i in starts], chunk, starts)


def _short(m: Model, chunks: list[str], keys: np.ndarray, dropout: float, made: list | None = None, barred: np.ndarray | None = None) -> list[bytes]:
    """Chunks of similar length, one merge of each in a step; made takes chunks, starts and ends of their merges.

    barred: sorted codes of places (_place, by the chunk's number, which is then its key) that aren't merged."""
    n, width = len(chunks), max(map(len, chunks)) + 1
    size = m.size
    sym = np.full((n, width), -1, np.int32)
    lengths = np.array([len(c) for c in chunks])
    sym[np.arange(width) < lengths[:, None]] = m.char[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]
    sym = sym.ravel()
    place = np.arange(n * width)
    after, before = place + 1, place - 1  # symbols start where their first character does
    got, rank = m.merge(sym[:-1], sym[1:])
    becomes = np.append(got, np.int32(size))
    rank = np.append(rank, _NONE).reshape(n, width)
    rank[:, -1] = _NONE
    first = place[::width].copy()
    while len(first):
        col = rank.argmin(1)
        row = np.flatnonzero(rank[np.arange(len(first)), col] != _NONE)
        if len(row) < 0.7 * len(first):
            rank, first, keys, col = rank[row], first[row], keys[row], col[row]
            row = np.arange(len(first))
        if not len(row):
            break
        c = col[row]
        at = first[row] + c
        gone = after[at]
        if dropout or barred is not None:
            to = after[gone] - first[row]
            skip = _dropped(keys[row], c, to, dropout) if barred is None else np.isin(_place(keys[row].astype(np.int64), c, to), barred)
            rank[row[skip], c[skip]] = _NONE
            row, c, at, gone = row[~skip], c[~skip], at[~skip], gone[~skip]
        if made is not None:
            made.append((first[row] // width, c, after[gone] - first[row]))
        new, right = becomes[at], after[gone]
        sym[at], sym[gone], after[at], before[right] = new, -2, right, at
        rank[row, c + (gone - at)] = _NONE
        becomes[at], rank[row, c] = m.merge(new, sym[right])
        inner = c > 0
        row, c, at, new = row[inner], c[inner], at[inner], new[inner]
        left = before[at]
        becomes[left], rank[row, c - (at - left)] = m.merge(sym[left], new)
    final_sym = sym.reshape(n, width)
    counts = (final_sym >= 0).sum(1)
    flat = final_sym[final_sym >= 0].astype("<u4").tobytes()
    ends = np.cumsum(counts) * 4
    odd = (final_sym == size).any(1)
    out = [flat[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
    for i in np.flatnonzero(odd):
        out[i] = _written(m, final_sym[i][final_sym[i] >= 0].tolist(), chunks[i], np.flatnonzero(final_sym[i] >= 0).tolist())
    return out


class Encoder:
    """Ids (little-endian, 32 bits) of texts; remembers a bounded number of chunks."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED) -> None:
        self.model, self.dropout, self.seed = model(path), dropout, seed
        self.forget()

    def forget(self) -> None:
        """Remembered chunks and branches: ids, and bounds of their merges in starts and ends; numbers and crc32
        of chunks; by number, the chunk and the places that a branch doesn't merge; branches by number and merge."""
        self.known: dict[str | None, int] = {None: 0}
        self.plain = [np.array([self.model.byte[b] for b in BLANK.encode()], "<u4").tobytes()]
        self.crcs, self.bounds = np.zeros(1, np.uint64), np.zeros(2, np.int64)
        self.chunk, self.long = [""], np.zeros(1, bool)
        self.without: list[tuple[int, ...]] = [()]
        self.branches: dict[int, int] = {}
        self.starts, self.ends = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def merged(self, chunks: list[str], keys: np.ndarray, dropout: float, made: list | None = None, without: list[tuple[int, ...]] | None = None) -> list[bytes]:
        """Ids of chunks; made takes arrays of chunks, starts and ends of merges. without: the places of each chunk, none
        of them long, that aren't merged, instead of draws."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        group = np.where(sizes > LONG, -1, (sizes + 2) // 3)
        order = np.argsort(group, kind="stable")
        found: list[bytes] = []
        for i in order[: int((group < 0).sum())].tolist():
            own: list[tuple[int, int]] | None = None if made is None else []
            found.append(_long(self.model, chunks[i], int(keys[i]), dropout, own))
            if own:
                made.append((np.full(len(own), i), *np.array(own).T))
        cuts = [*np.flatnonzero(np.diff(group[order], prepend=-1)).tolist(), len(order)]
        for first, last in itertools.pairwise(cuts):
            for a in range(first, last, 8192):
                some, steps = order[a : min(last, a + 8192)], None if made is None else []
                barred, own_keys = None, keys[some]
                if without is not None:
                    barred, own_keys = np.array([_place(n, 0, p) for n, i in enumerate(some.tolist()) for p in without[i]], np.int64), np.arange(len(some))
                found += _short(self.model, [chunks[i] for i in some.tolist()], own_keys, dropout, steps, barred)
                if steps:
                    made += [(some[rows], start, end) for rows, start, end in steps]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return list(map(found.__getitem__, place.tolist()))

    def learn(self, chunks: list[str]) -> None:
        self.known.update(zip(chunks, range(len(self.plain), len(self.plain) + len(chunks)), strict=True))
        self._remember(chunks, [()] * len(chunks), _crcs(chunks))

    def _remember(self, chunks: list[str], without: list[tuple[int, ...]], crcs: np.ndarray) -> None:
        made: list = []
        self.plain += self.merged(chunks, np.zeros(len(chunks), np.uint64), 0.0, made, without if any(without) else None)
        self.chunk += chunks
        self.without += without
        self.crcs = np.concatenate([self.crcs, crcs])
        self.long = np.concatenate([self.long, np.fromiter((len(c) > LONG for c in chunks), bool, len(chunks))])
        rows, starts, ends = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in made)]) for i in range(3))
        order = np.argsort(rows, kind="stable")
        self.starts = np.concatenate([self.starts, starts[order].astype(np.int32)])
        self.ends = np.concatenate([self.ends, ends[order].astype(np.int32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.bincount(rows, minlength=len(chunks)))])

    def _branch(self, codes: list[int]) -> range:
        """Remembers branches; a code is a number and the number's merge that is skipped first."""
        chunks, without = [], []
        for code in codes:
            node, merge = code >> 6, int(self.bounds[code >> 6]) + (code & 63)
            chunks.append(self.chunk[node])
            without.append((*self.without[node], int(_place(0, self.starts[merge], self.ends[merge]))))
        new = range(len(self.plain), len(self.plain) + len(codes))
        self._remember(chunks, without, np.zeros(len(codes), np.uint64))
        self.branches.update(zip(codes, new, strict=True))
        return new

    def _skips(self, nodes: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """The first merge of each that its draws skip; -1 if none."""
        n = self.bounds[nodes + 1] - self.bounds[nodes]
        which = np.repeat(np.arange(len(nodes)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        merge = nth + np.repeat(self.bounds[nodes], n)
        hit = np.flatnonzero(_dropped(drawn[which], self.starts[merge], self.ends[merge], self.dropout))
        out = np.full(len(nodes), -1)
        some, first = np.unique(which[hit], return_index=True)
        out[some] = nth[hit[first]]
        return out

    def _vary(self, nodes: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """Moves occurrences to the branches that their draws lead to; those that are to be merged by themselves get -1."""
        nodes, live = nodes.copy(), np.arange(len(nodes))
        while len(live):
            first = np.concatenate([self._skips(nodes[x], drawn[x]) for x in np.split(live, range(65536, len(live), 65536))])
            live, first = live[first >= 0], first[first >= 0]
            code, back, count = np.unique(nodes[live] * 64 + first, return_inverse=True, return_counts=True)
            to = np.fromiter(map(self.branches.get, code.tolist(), itertools.repeat(-1)), np.int64, len(code))
            short = ~self.long[code >> 6]
            new = np.flatnonzero((to < 0) & (count > 1) & short)[: max(0, KNOWN - len(self.plain))]
            if len(new):
                to[new] = self._branch(code[new].tolist())
            nodes[live] = np.where(short, to, -1)[back]
            live = live[nodes[live] >= 0]
        return nodes

    def chunks(self, text: str) -> list[str]:
        """A text's chunks; those of blank signs in the text itself are None."""
        out: list[str | None] = []
        for i, part in enumerate(text.split(BLANK)):
            if i:
                out.append(None)
            part = part.replace(" ", BLANK)
            out += _CHUNK.findall(BLANK + part if i == 0 and text else part)
        return out

    def __call__(self, texts: list[str | None], keys: list[int]) -> list[bytes]:
        if len(self.plain) > KNOWN:
            self.forget()
        parts = [self.chunks(t or "") for t in texts]
        sizes = [len(p) for p in parts]
        flat = list(itertools.chain.from_iterable(parts))
        if lacking := set(flat).difference(self.known):
            self.learn(list(lacking))
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        alone, ids = np.zeros(0, np.int64), []
        if self.dropout and flat:
            drawn = _keyed(self.crcs[at], _occurrences(self.seed, keys, sizes))
            at = self._vary(at, drawn)
            alone = np.flatnonzero(at < 0)
            ids = self.merged([flat[i] for i in alone.tolist()], drawn[alone], self.dropout)
        out = list(map(self.plain.__getitem__, at.tolist()))
        for i, x in zip(alone.tolist(), ids, strict=True):
            out[i] = x
        ends = itertools.accumulate(sizes)
        return [b"".join(out[z - n : z]) for n, z in zip(sizes, ends, strict=True)]


def decode_ids(m: Model, ids: bytes) -> str:
    """The text that was encoded."""
    if not ids:
        return ""
    return b"".join(map(m.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "surrogatepass")[1:]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """docs with ids (binary, little-endian 32-bit) and n_pieces."""
    path = path or model_path()
    names = ["ids", "n_pieces"]
    docs = docs.drop(*[c for c in docs.columns if c in names])
    at, ident = docs.columns.index(text), docs.columns.index(key)
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_pieces", T.LongType())])

    @quietly  # strings and bytes by the million
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, dropout, seed)
        for b in batches:
            texts = b.column(at).to_pylist()
            keys = [zlib.crc32(str("" if k is None else k).encode()) for k in b.column(ident).to_pylist()]
            for x, y in runs(texts, 2_000_000):
                ids = encoder(texts[x:y], keys[x:y])
                yield pa.RecordBatch.from_arrays([*b.slice(x, y - x).columns, pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())], names=[*b.schema.names, *names])

    return docs.mapInArrow(task, schema)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """encoded with decoded, the text of the ids."""
    path = path or model_path()
    encoded = encoded.drop("decoded")
    at = encoded.columns.index(ids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            for x in range(0, b.num_rows, 500):
                part = b.slice(x, 500)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([decode_ids(m, i or b"") for i in part.column(at).to_pylist()], pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(task, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded: number and crc32 of the ids, and of the text read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    found = decode(encode(docs).drop("text"))
    back = F.crc32(F.col("decoded").cast("binary"))
    return found.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.octet_length("decoded").cast("long").alias("n_bytes"), back.alias("decoded_crc32"), (back == F.col("text_crc32")).alias("lossless"))
