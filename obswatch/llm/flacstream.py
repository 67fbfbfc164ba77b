"""FLAC streams of any encoder: 1 to 8 channels, 4 to 32 bits a sample, all predictor orders and Rice forms.

The module flac codes many small mono files of its own at once; this one reads a stream as the format defines
it, frame by frame: fixed predictors to order 4, linear ones to order 32, Rice parameters of 4 or 5 bits by
partition, partitions of plain numbers, wasted bits, and side channels. Header and frame checksums are
verified, and the md5 of the stream where a whole one is read. Frames are found by decoding them one after
another, so that a stream needs no seek table; one that has it is entered at the last seek point before the
sample that is asked for.

Defined results: a broken checksum, a reserved code or a stream that ends within a frame raises ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from obswatch.llm.flac import FIXED, _crc_table, crc8

_SIZES = {1: 192, **{i: 576 << (i - 2) for i in range(2, 6)}, **{i: 256 << (i - 8) for i in range(8, 16)}}
_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


@dataclass(frozen=True)
class Info:
    """What a stream says of itself; points: first sample and place in the file of frames."""

    rate: int
    channels: int
    bits: int
    samples: int
    md5: bytes
    first_frame: int
    points: tuple[tuple[int, int], ...]


def info(media: bytes) -> Info:
    if media[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, last, head, points = 4, False, b"", []
    while not last:
        if at + 4 > len(media):
            raise ValueError("the stream ends within its metadata")
        last, kind, size = media[at] >= 0x80, media[at] & 0x7F, int.from_bytes(media[at + 1 : at + 4], "big")
        block = media[at + 4 : at + 4 + size]
        if kind == 0:
            head = block
        elif kind == 3:
            points += [(int.from_bytes(block[i : i + 8], "big"), int.from_bytes(block[i + 8 : i + 16], "big")) for i in range(0, len(block) - 17, 18)]
        at += 4 + size
    if len(head) < 34:
        raise ValueError("no stream information")
    packed = int.from_bytes(head[10:18], "big")
    seen = tuple((s, at + o) for s, o in points if s < (1 << 64) - 1)
    return Info(packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & ((1 << 36) - 1), head[18:34], at, seen)


class _Bits:
    """Bits of a stream from a byte on."""

    def __init__(self, data: bytes, at: int) -> None:
        self.data, self.at = data, 8 * at

    def read(self, n: int) -> int:
        end = self.at + n
        if end > 8 * len(self.data):
            raise ValueError("the stream ends within a frame")
        whole = int.from_bytes(self.data[self.at >> 3 : (end + 7) >> 3], "big")
        self.at = end
        return whole >> (-end & 7) & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        v = self.read(n)
        return v - (v >> (n - 1) << n) if n else 0

    def zeros(self) -> int:
        """How many zeros come before the next one, which is read too."""
        n = 0
        while not self.read(1):
            byte, skip = self.at >> 3, 0
            n += 1
            while not self.at & 7 and byte + skip < len(self.data) and not self.data[byte + skip]:
                skip += 1
            self.at, n = self.at + 8 * skip, n + 8 * skip
        return n


def _residuals(b: _Bits, size: int, order: int) -> list[int]:
    form = b.read(2)
    if form > 1:
        raise ValueError("a reserved form of residuals")
    wide, out, parts = 4 + form, [], b.read(4)
    if size & ((1 << parts) - 1) or size >> parts < order:
        raise ValueError("partitions that don't fit their frame")
    for i in range(1 << parts):
        n, k = (size >> parts) - (order if i == 0 else 0), b.read(wide)
        if k == (1 << wide) - 1:
            plain = b.read(5)
            out += [b.signed(plain) for _ in range(n)]
        else:
            for _ in range(n):
                z = b.zeros() << k | b.read(k)
                out.append(z >> 1 ^ -(z & 1))
    return out


def _subframe(b: _Bits, size: int, bits: int) -> np.ndarray:
    if b.read(1):
        raise ValueError("a broken subframe")
    kind, wasted = b.read(6), 0
    if b.read(1):
        wasted = b.zeros() + 1
    bits -= wasted
    if bits < 1:
        raise ValueError("more wasted bits than a sample has")
    if kind == 0:
        x = [b.signed(bits)] * size
    elif kind == 1:
        x = [b.signed(bits) for _ in range(size)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        if order > size:
            raise ValueError("a predictor longer than its frame")
        x, shift = [b.signed(bits) for _ in range(order)], 0
        if kind < 32:
            coefs = FIXED[order, :order].tolist()
        else:
            precision, shift = b.read(4) + 1, b.signed(5)
            if precision == 16 or shift < 0:
                raise ValueError("a reserved precision or shift")
            coefs = [b.signed(precision) for _ in range(order)]
        back = coefs[::-1]
        for r in _residuals(b, size, order):
            x.append(r + (sum(c * v for c, v in zip(back, x[len(x) - order :], strict=True)) >> shift))
    else:
        raise ValueError("a reserved kind of subframe")
    return np.array(x, np.int64) << wasted


def _crc16(data: bytes) -> int:
    t, c = _crc_table(0x8005, 16).tolist(), 0
    for x in data:
        c = c << 8 & 0xFFFF ^ t[c >> 8 ^ x]
    return c


def _frame(media: bytes, at: int, of: Info) -> tuple[np.ndarray, int]:
    """Samples (a row a channel) and end of the frame at a byte."""
    b = _Bits(media, at)
    if b.read(15) != 0x7FFC:
        raise ValueError("no frame where one should be")
    _, size_code, rate_code, channels, bits_code = b.read(1), b.read(4), b.read(4), b.read(4), b.read(3)
    if b.read(1) or channels > 10 or bits_code == 3 or size_code == 0 or rate_code == 15:
        raise ValueError("a reserved code in a frame header")
    lead = b.read(8)
    more = 8 - (lead ^ 0xFF).bit_length() if lead >= 0xC0 else 0
    b.read(8 * max(0, more - 1))
    size = b.read(8 * (size_code - 5)) + 1 if size_code in (6, 7) else _SIZES[size_code]
    b.read({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
    end = b.at >> 3
    if crc8(media[at:end]) != b.read(8):
        raise ValueError("bad frame header")
    bits = _BITS.get(bits_code, of.bits)
    count = channels + 1 if channels < 8 else 2
    x = [_subframe(b, size, bits + (channels in (8, 10) and i == 1 or channels == 9 and i == 0)) for i in range(count)]
    if channels == 8:
        x[1] = x[0] - x[1]
    elif channels == 9:
        x[0] = x[0] + x[1]
    elif channels == 10:
        middle = x[0] << 1 | x[1] & 1
        x = [(middle + x[1]) >> 1, (middle - x[1]) >> 1]
    end = (b.at + 7) >> 3
    if _crc16(media[at:end]) != int.from_bytes(media[end : end + 2], "big") or end + 2 > len(media):
        raise ValueError("bad frame checksum")
    return np.stack(x), end + 2


def pcm(x: np.ndarray, bits: int) -> bytes:
    """Samples by channel as interleaved little-endian signed numbers of whole bytes, as the stream's md5 takes them."""
    wide = (bits + 7) // 8
    return np.ascontiguousarray(x.T.astype("<i8")).view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def frames(media: bytes, first: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """First sample and samples of each frame, from that on which has a sample (or a seek point before it)."""
    of = info(media)
    start, at = max(((s, o) for s, o in of.points if s <= first), default=(0, of.first_frame))
    while at < len(media):
        x, at = _frame(media, at, of)
        yield start, x
        start += x.shape[1]
        if of.samples and start >= of.samples:
            return


def read_at(media: bytes, first: int, count: int) -> bytes:
    """PCM of samples from first on."""
    of, out = info(media), []
    for start, x in frames(media, first):
        if start >= first + count:
            break
        out.append(pcm(x[:, max(0, first - start) : max(0, first + count - start)], of.bits))
    return b"".join(out)


def blocks(media: bytes, samples: int) -> Iterator[tuple[int, int, bytes]]:
    """First sample, number of samples and PCM of blocks; memory is that of a block and a frame. The md5 is verified at the end."""
    of, digest, held, at = info(media), hashlib.md5(), [], 0
    wide = (of.bits + 7) // 8 * of.channels

    def cut(data: bytes, last: bool) -> Iterator[tuple[int, int, bytes]]:
        nonlocal held, at
        while len(data) >= samples * wide or last and data:
            block, data = data[: samples * wide], data[samples * wide :]
            yield at, len(block) // wide, block
            at += len(block) // wide
        held = [data]

    waiting = 0
    for _, x in frames(media):
        data = pcm(x, of.bits)
        digest.update(data)
        held.append(data)
        waiting += len(data)
        if waiting >= samples * wide:
            yield from cut(b"".join(held), False)
            waiting = len(held[0])
    yield from cut(b"".join(held), True)
    if of.samples and at != of.samples or any(of.md5) and digest.digest() != of.md5:
        raise ValueError("bad stream checksum")
