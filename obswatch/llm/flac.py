"""Media columns: FLAC, mono, 8 bits a sample.

The encoder cuts samples into frames, picks a constant, verbatim, fixed or linear predictor for each and
writes the residuals as Rice codes; a seek table has the offset of every frame. The decoder verifies the
checksums of headers and frames and the stream's md5, decodes Rice codes and predictors, and gives PCM
blocks by sample offset; streams of other encoders are read by flacstream. Frames don't depend on each other, so both work on many frames at once: numpy
takes the n-th sample of all frames of a group in one step, and groups are of bounded size.

Defined results: a null text is empty; a payload is the UTF-8 of a text and bytes 0 up to a positive
multiple of 64; samples are the payload's bytes less 128; equal texts give equal bytes and features; an
empty table gives no rows; a broken checksum raises ValueError. Input columns named as an output are
replaced, others are kept.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obswatch.llm.common import append_columns, table

FRAME, RATE, ORDER, PRECISION = 512, 8000, 4, 8
#: Frames that are coded at once.
GROUP = 4096
FIXED = np.array([[0, 0, 0, 0], [1, 0, 0, 0], [2, -1, 0, 0], [3, -3, 1, 0], [4, -6, 4, -1]], np.int64)


@functools.cache
def _crc_table(poly: int, bits: int) -> np.ndarray:
    out, top, mask = [], 1 << (bits - 1), (1 << bits) - 1
    for i in range(256):
        c = i << (bits - 8)
        for _ in range(8):
            c = (c << 1 ^ poly if c & top else c << 1) & mask
        out.append(c)
    return np.array(out, np.uint32)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = int(_crc_table(0x07, 8)[c ^ b])
    return c


def crc16(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each row's first bytes."""
    t, c = _crc_table(0x8005, 16), np.zeros(len(rows), np.uint32)
    order = np.argsort(-lengths, kind="stable")
    cols, sorted_lengths = np.ascontiguousarray(rows[order].T), -lengths[order]
    done = np.zeros(len(rows), np.uint32)
    for i in range(rows.shape[1]):
        m = int(np.searchsorted(sorted_lengths, -i, side="left"))  # rows longer than i
        if not m:
            break
        done[:m] = ((done[:m] << 8) & 0xFFFF) ^ t[(done[:m] >> 8) ^ cols[i, :m]]
    c[order] = done
    return c


@functools.lru_cache(100_000)
def _header(number: int, size: int) -> bytes:
    if number < 0x80:
        coded = bytes([number])
    else:  # as UTF-8, extended to 36 bits
        more: list[int] = []
        while not more or number >= 1 << (6 - len(more)):
            more.append(0x80 | number & 0x3F)
            number >>= 6
        coded = bytes([(0xFF << (7 - len(more))) & 0xFF | number, *more[::-1]])
    head = bytes([0xFF, 0xF8, (0x94 if size == FRAME else 0x74), 0x02]) + coded + (b"" if size == FRAME else struct.pack(">H", size - 1))
    return head + bytes([crc8(head)])


def _linear(x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients of order 4 and their shift, by Levinson-Durbin on each row's autocorrelation."""
    f = np.where(inside, x, 0).astype(np.float64)
    r = np.stack([(f[:, : f.shape[1] - k] * f[:, k:]).sum(1) for k in range(ORDER + 1)], 1)
    a, error = np.zeros((len(x), ORDER)), np.maximum(r[:, 0], 1e-9)
    for m in range(ORDER):
        k = (r[:, m + 1] - (a[:, :m] * r[:, m:0:-1]).sum(1)) / error
        k = np.clip(k, -0.999, 0.999)
        if m:
            a[:, :m] -= k[:, None] * a[:, m - 1 :: -1][:, :m]
        a[:, m] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    most = np.maximum(np.abs(a).max(1), 1e-9)
    shift = np.clip(PRECISION - 2 - np.floor(np.log2(most)).astype(np.int64) - 1, 0, 15)
    limit = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (2.0 ** shift)[:, None]), -limit - 1, limit).astype(np.int64), shift


def _residual(x: np.ndarray, coefs: np.ndarray, shift: np.ndarray) -> np.ndarray:
    guess = np.zeros_like(x)
    for j in range(ORDER):
        guess[:, j + 1 :] += coefs[:, j : j + 1] * x[:, : x.shape[1] - j - 1]
    return x - (guess >> shift[:, None])


def _frames(x: np.ndarray, n: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """The frames of rows of samples, of which the first n count."""
    rows, width = x.shape
    at = np.arange(width)
    inside = at < n[:, None]
    lpc, lpc_shift = _linear(x, inside)
    coefs = np.concatenate([np.broadcast_to(FIXED[:, None], (5, rows, 4)), lpc[None]])
    shifts = np.concatenate([np.zeros((5, rows), np.int64), lpc_shift[None]])
    orders = np.array([0, 1, 2, 3, 4, ORDER])
    sums = np.stack([(np.abs(_residual(x, coefs[c], shifts[c])) * (inside & (at >= orders[c]))).sum(1) for c in range(6)])
    sums[5] += 12  # for the coefficients' bits
    pick = np.argmin(sums, 0)
    every = np.arange(rows)
    order, coef, shift = orders[pick], coefs[pick, every], shifts[pick, every]
    res = _residual(x, coef, shift)
    coded = inside & (at >= order[:, None])
    z = np.where(coded, np.where(res < 0, -2 * res - 1, 2 * res), 0)
    count = np.maximum(n - order, 1)
    k = np.clip(np.floor(np.log2(np.maximum(z.sum(1) / count * 0.7, 1e-9))).astype(np.int64), 0, 14)
    costs = np.stack([(z >> np.clip(k + d, 0, 14)[:, None]).sum(1) + count * (np.clip(k + d, 0, 14) + 1) for d in (0, 1)])
    k = np.clip(k + np.argmin(costs, 0), 0, 14)
    is_lpc = pick == 5
    bits = costs.min(0) + 10 + 8 * order + is_lpc * (9 + PRECISION * ORDER)
    constant = (np.where(inside, x, x[:, :1]) == x[:, :1]).all(1)
    verbatim = ~constant & (bits >= 8 * n)
    plain = constant | verbatim
    # a row of items (value, bits) for each frame: header, warm-up, coefficients, residuals
    value, size = np.zeros((rows, 15 + width), np.int64), np.zeros((rows, 15 + width), np.int64)
    value[:, 0] = np.where(constant, 0, np.where(verbatim, 2, np.where(is_lpc, (32 | ORDER - 1) << 1, (8 | order) << 1)))
    size[:, 0] = 8
    warm = (np.arange(4) < order[:, None]) & ~plain[:, None]
    value[:, 1:5], size[:, 1:5] = np.where(warm, x[:, :4] & 0xFF, 0), 8 * warm
    own = is_lpc & ~plain
    value[:, 5], size[:, 5] = np.where(own, (PRECISION - 1) << 5 | shift, 0), 9 * own
    value[:, 6:10], size[:, 6:10] = np.where(own[:, None], coef & ((1 << PRECISION) - 1), 0), PRECISION * own[:, None]
    value[:, 14], size[:, 14] = np.where(plain, 0, k), 10 * ~plain
    body_value = np.where(plain[:, None], x & 0xFF, (1 << k[:, None]) | (z & ((1 << k[:, None]) - 1)))
    body_size = np.where(verbatim[:, None], 8 * inside, np.where(constant[:, None], 8 * (at == 0), np.where(coded, (z >> k[:, None]) + 1 + k[:, None], 0)))
    value[:, 15:], size[:, 15:] = np.where(body_size > 0, body_value, 0), body_size
    ends = np.cumsum(size, 1)
    length = (ends[:, -1] + 7) // 8
    first = np.concatenate([[0], np.cumsum(length)])
    ends += 8 * first[:-1, None]
    stream = np.zeros(8 * int(first[-1]), np.uint8)
    flat_value, flat_end = value.ravel(), ends.ravel()
    some = np.flatnonzero(flat_value)
    v, e, b = flat_value[some], flat_end[some], 1
    while len(v):
        stream[(e - b)[(v & 1) == 1]] = 1
        v, b = v >> 1, b + 1
        on = v > 0
        v, e = v[on], e[on]
    body = np.packbits(stream).tobytes()
    heads = [_header(int(i), int(m)) for i, m in zip(numbers, n, strict=True)]
    out = [h + body[a:z] for h, a, z in zip(heads, first[:-1], first[1:], strict=True)]
    sums = crc16(*_padded(out))
    return [f + struct.pack(">H", c) for f, c in zip(out, sums.tolist(), strict=True)]


def _padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts], np.int64)
    most = int(lengths.max())
    return np.frombuffer(b"".join(p.ljust(most, b"\0") for p in parts), np.uint8).reshape(len(parts), most), lengths


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC file of each payload, of 64 bytes at least."""
    sizes = [min(FRAME, len(p) - a) for p in payloads for a in range(0, len(p), FRAME)]
    numbers = [i for p in payloads for i in range((len(p) + FRAME - 1) // FRAME)]
    cut = (p[a : a + FRAME] for p in payloads for a in range(0, len(p), FRAME))
    frames: list[bytes] = []
    for a in range(0, len(sizes), GROUP):
        n = np.array(sizes[a : a + GROUP], np.int64)
        rows = b"".join(next(cut).ljust(FRAME, b"\x80") for _ in range(len(n)))
        x = np.frombuffer(rows, np.uint8).reshape(-1, FRAME).astype(np.int64) - 128
        frames += _frames(x, n, np.array(numbers[a : a + GROUP]))
    out, at = [], 0
    for p in payloads:
        m = (len(p) + FRAME - 1) // FRAME
        own = frames[at : at + m]
        at += m
        lengths = [len(f) for f in own]
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        points = b"".join(struct.pack(">QQH", i * FRAME, int(o), min(FRAME, len(p) - i * FRAME)) for i, o in enumerate(offsets))
        md5 = hashlib.md5((np.frombuffer(p, np.uint8) ^ 0x80).tobytes()).digest()
        info = struct.pack(">HH", FRAME, FRAME) + min(lengths).to_bytes(3, "big") + max(lengths).to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + md5
        out.append(b"fLaC" + b"\x00" + (34).to_bytes(3, "big") + info + _blocks_of(points) + b"".join(own))
    return out


def _blocks_of(points: bytes) -> bytes:
    """Seek tables, of 24 bits of length each at most; the last one ends the metadata."""
    step = 18 * 900_000
    parts = [points[a : a + step] for a in range(0, len(points), step)]
    return b"".join(bytes([3 | 0x80 * (i == len(parts) - 1)]) + len(p).to_bytes(3, "big") + p for i, p in enumerate(parts))


def parse(media: bytes) -> tuple[int, bytes, list[tuple[int, int, int]]]:
    """Number of samples, md5, and the seek points: first sample, offset in the file, number of samples."""
    if media[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, last, points, total, md5 = 4, False, [], 0, b""
    while not last:
        last, kind, size = media[at] >= 0x80, media[at] & 0x7F, int.from_bytes(media[at + 1 : at + 4], "big")
        block = media[at + 4 : at + 4 + size]
        if kind == 0:
            total, md5 = int.from_bytes(block[10:18], "big") & ((1 << 36) - 1), block[18:34]
        elif kind == 3:
            points += struct.iter_unpack(">QQH", block)
        at += 4 + size
    return total, md5, [(s, at + o, n) for s, o, n in points]


@functools.lru_cache(100_000)
def _check_header(head: bytes, number: int, size: int) -> int:
    if not head.startswith(want := _header(number, size)):
        raise ValueError("bad frame header")
    return len(want)


def decode_frames(frames: list[bytes], numbers: list[int], sizes: list[int]) -> list[np.ndarray]:
    """The samples of each frame; checksums are verified."""
    heads = np.array([_check_header(f[:16], i, n) for f, i, n in zip(frames, numbers, sizes, strict=True)], np.int64)
    rows, lengths = _padded(frames)
    given = rows[np.arange(len(rows)), lengths - 2].astype(np.uint32) << 8 | rows[np.arange(len(rows)), lengths - 1]
    if (crc16(rows, lengths - 2) != given).any():
        raise ValueError("bad frame checksum")
    order = np.argsort(-np.array(sizes), kind="stable")
    rows, heads, n = rows[order], heads[order], np.array(sizes, np.int64)[order]
    count, width = len(rows), int(n[0])
    wide = np.zeros((count, rows.shape[1] + 16), np.uint8)
    wide[:, : rows.shape[1]] = rows
    window = np.zeros(wide.shape[0] * wide.shape[1], np.uint64)
    flat = np.concatenate([wide.ravel(), np.zeros(8, np.uint8)])
    for i in range(8):
        window |= flat[i : i + len(window)].astype(np.uint64) << np.uint64(56 - 8 * i)
    base = np.arange(count, dtype=np.int64) * wide.shape[1] * 8
    p = base + 8 * heads

    def read(bits: int | np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        nonlocal p
        w = window[p >> 3] << (p & 7).astype(np.uint64)
        bits = np.where(True if live is None else live, bits, 0)
        p = p + bits
        return np.where(bits > 0, w >> (64 - np.maximum(bits, 1)).astype(np.uint64), np.uint64(0)).astype(np.int64)

    def signed(v: np.ndarray, bits: int) -> np.ndarray:
        return v - ((v >> (bits - 1)) << bits)

    kind = read(8) >> 1
    constant, verbatim, is_lpc = kind == 0, kind == 1, kind >= 32
    order_of = np.where(is_lpc, kind - 31, np.where(constant | verbatim, 0, kind - 8))
    if (order_of > ORDER).any() or (order_of < 0).any():
        raise ValueError("a predictor of another order")
    out = np.zeros((width, count), np.int64)
    begin = p.copy()
    for j in range(ORDER):
        if j < width:
            out[j] = signed(read(8, j < order_of), 8)
    coefs = FIXED[np.where(is_lpc, 0, order_of)].copy()
    precision, shift = read(4, is_lpc) + 1, read(5, is_lpc)
    for j in range(ORDER):
        v = read(precision, is_lpc & (j < order_of))
        coefs[:, j] = np.where(is_lpc, np.where(j < order_of, v - ((v >> (precision - 1)) << precision), 0), coefs[:, j])
    rice = ~(constant | verbatim)
    if (read(6, rice) != 0).any():
        raise ValueError("more than one partition")
    k = read(4, rice)
    # lanes in which residuals are coded come first among those of equal length
    lanes = np.lexsort((~rice, -n))
    live_n = np.where(rice, n, 0)[lanes]
    resort = np.argsort(-live_n, kind="stable")
    lanes = lanes[resort]
    live_n = live_n[resort]
    pos, kk, co, sh, od = p[lanes], k[lanes], coefs[lanes], shift[lanes], order_of[lanes]
    ku, hist = kk.astype(np.uint64), np.zeros((ORDER, len(lanes)), np.int64)
    samples = out[:, lanes]
    c0, c1, c2, c3 = (np.ascontiguousarray(co[:, i]) for i in range(4))
    masks = (np.int64(1) << kk) - 1
    for j in range(int(live_n[0]) if len(live_n) else 0):
        m = int(np.searchsorted(-live_n, -j, side="left"))
        q = pos[:m]
        w = window[q >> 3] << (q & 7).astype(np.uint64)
        top = (w >> np.uint64(32)).astype(np.float64)
        zeros = 32 - np.frexp(top)[1].astype(np.int64)
        far = np.flatnonzero(top == 0)
        coded = j >= od[:m]
        if len(far):
            for i in far[coded[far]]:
                z, at = 0, int(q[i])
                while not flat[at >> 3] >> (7 - (at & 7)) & 1:
                    z, at = z + 1, at + 1
                zeros[i] = z
        end = q + zeros + 1
        low = ((window[end >> 3] << (end & 7).astype(np.uint64)) >> np.uint64(32)).astype(np.int64) >> (32 - kk[:m])
        z = (zeros << kk[:m]) | (low & masks[:m])
        r = (z >> 1) ^ -(z & 1)
        guess = (c0[:m] * hist[0, :m] + c1[:m] * hist[1, :m] + c2[:m] * hist[2, :m] + c3[:m] * hist[3, :m]) >> sh[:m]
        if j < ORDER:
            value = np.where(coded, guess + r, samples[j, :m])
            pos[:m] = np.where(coded, end + kk[:m], q)
        else:
            value = guess + r
            pos[:m] = end + kk[:m]
        samples[j, :m] = value
        hist[1:, :m] = hist[:-1, :m].copy()
        hist[0, :m] = value
    out[:, lanes] = samples
    result: list[np.ndarray] = [np.zeros(0, np.int16)] * count
    columns = out.T
    for i in range(count):
        a = int(begin[i] >> 3)
        if constant[i]:
            row = np.full(n[i], np.int8(flat[a : a + 1].view(np.int8)[0]))
        elif verbatim[i]:
            row = flat[a : a + n[i]].view(np.int8)
        else:
            row = columns[i, : n[i]]
        result[order[i]] = row.astype(np.int16)
    return result


def decode(files: list[bytes]) -> list[bytes]:
    """The payload of each file; its md5 is verified."""
    parsed = [parse(f) for f in files]
    todo = [(f, i, s, o, n, (points[i + 1][1] if i + 1 < len(points) else len(f))) for f, (_, _, points) in zip(files, parsed, strict=True) for i, (s, o, n) in enumerate(points)]
    got: list[bytes] = []
    for a in range(0, len(todo), GROUP):
        part = todo[a : a + GROUP]
        rows = decode_frames([f[o:e] for f, _, _, o, _, e in part], [i for _, i, *_ in part], [n for *_, n, _ in part])
        got += [(r + 128).astype(np.uint8).tobytes() for r in rows]
    out, at = [], 0
    for total, md5, points in parsed:
        payload = b"".join(got[at : at + len(points)])
        at += len(points)
        if len(payload) != total or hashlib.md5((np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()).digest() != md5:
            raise ValueError("bad stream checksum")
        out.append(payload)
    return out


def read_at(media: bytes, first: int, count: int) -> bytes:
    """The payload's bytes from sample first on: only the frames that hold them are decoded."""
    _, _, points = parse(media)
    ends = [o for _, o, _ in points[1:]] + [len(media)]
    some = [(i, s, o, n, e) for i, ((s, o, n), e) in enumerate(zip(points, ends, strict=True)) if s < first + count and s + n > first]
    if not some:
        return b""
    rows = decode_frames([media[o:e] for _, _, o, _, e in some], [i for i, *_ in some], [n for _, _, _, n, _ in some])
    joined = (np.concatenate(rows) + 128).astype(np.uint8).tobytes()
    skip = first - some[0][1]
    return joined[skip : skip + count]


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(-len(data) % 64 if data else 64)


def feature(payload: bytes) -> str:
    """Peak, mean size, sign changes and mean step of the samples, in whole numbers."""
    x = np.frombuffer(payload, np.uint8).astype(np.int32) - 128
    steps = int(np.abs(np.diff(x)).sum()) if len(x) > 1 else 0
    return f"peak={int(np.abs(x).max())};level={int(np.abs(x).sum()) * 100 // len(x)};turns={int(((x[1:] < 0) != (x[:-1] < 0)).sum())};step={steps * 100 // len(x)}"


def stored(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_bytes and media, the FLAC file of the text's payload."""

    def make():
        def fn(texts: list[str | None]) -> list[list]:
            return [[len((t or "").encode("utf-8", "surrogatepass")) for t in texts], encode([payload_of(t) for t in texts])]

        return fn

    return append_columns(docs, text, [("n_bytes", T.LongType()), ("media", T.BinaryType())], make)


def _slices(batch: pa.RecordBatch, column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes in a column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, s in enumerate(sizes):
        size += int(s)
        if size >= limit:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def features(media: DataFrame) -> DataFrame:
    """From frames with media: it is read back, verified, and replaced by its digests and features."""
    fields = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]
    names = [n for n, _ in fields]
    media = media.drop(*[c for c in media.columns if c in names])
    rest = [f for f in media.schema.fields if f.name != "media"]
    schema = T.StructType(rest + [T.StructField(n, t) for n, t in fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, "media"):
                files = b.column(b.schema.get_field_index("media")).to_pylist()
                back = decode(files)
                out = [
                    pa.array([len(p) for p in back], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in back]), pa.array([zlib.crc32(p[-64:]) for p in back], pa.int64()),
                    pa.array([len(f) for f in files], pa.int64()), pa.array([hashlib.sha256(f).hexdigest() for f in files]), pa.array([feature(p) for p in back]),
                ]
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in rest), *out], names=[*(f.name for f in rest), *names])

    return media.mapInArrow(task, schema)


def pcm_blocks(media: DataFrame, key: str, samples: int = 65536) -> DataFrame:
    """A row for each block of samples: key, sample_offset, n_samples, pcm (signed, little-endian, channels by turns).

    The files may be of any FLAC encoder; a null one has no blocks."""
    kind = media.schema[key].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from obswatch.llm import flacstream

        for b in batches:
            for i, f in enumerate(b.column(1).to_pylist()):
                for at, n, pcm in () if f is None else _own_blocks(f, samples) if _is_own(f) else flacstream.blocks(f, samples):
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([at], pa.int64()), pa.array([n], pa.int64()), pa.array([pcm])], names=[key, "sample_offset", "n_samples", "pcm"])

    return media.select(key, "media").mapInArrow(task, f"{key} {kind}, sample_offset long, n_samples long, pcm binary")


def _is_own(media: bytes) -> bool:
    """Whether the stream information is that of this encoder: 8 bits, mono, frames of one size, at the known rate; then it
    says so by a seek point a frame."""
    if media[:5] != b"fLaC\0" or media[8:12] != struct.pack(">HH", FRAME, FRAME):
        return False
    total, _, points = parse(media)
    return int.from_bytes(media[18:26], "big") >> 36 == RATE << 8 | 7 and [(s, n) for s, _, n in points] == [(a, min(FRAME, total - a)) for a in range(0, total, FRAME)]


def _own_blocks(media: bytes, samples: int) -> Iterator[tuple[int, int, bytes]]:
    for a in range(0, parse(media)[0], samples):
        pcm = (np.frombuffer(read_at(media, a, samples), np.uint8) ^ 0x80).tobytes()
        yield a, len(pcm), pcm


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as FLAC, read back."""
    return features(stored(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "media"))
