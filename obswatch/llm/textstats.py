"""Counts over one whole text that the quality operators share.

Words are maximal runs of characters other than space and U+0009 to U+000D, which is what bytes.split()
yields on UTF-8. A null text counts as an empty one.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8

_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of so many words (a power of two) that occurs twice or more."""
    if len(ids) <= window:
        return 0
    keys = ids.astype(np.uint64) * _MIX
    keys ^= keys >> np.uint64(29)
    step = 1
    while step < window:  # equal windows have equal keys, so keys that all differ settle it
        keys = (keys[:-step] * np.uint64(0xBF58476D1CE4E5B9)) ^ (keys[step:] * _MIX + (keys[step:] >> np.uint64(31)))
        step *= 2
    order = np.sort(keys)
    if not (order[1:] == order[:-1]).any():
        return 0
    exact, step = ids.astype(np.int64), 1
    while step < window:  # ids of pairs, of fours, of eights: nothing is left to chance
        pair = exact[:-step] * (int(exact.max()) + 1) + exact[step:]
        exact = np.unique(pair, return_inverse=True)[1]
        step *= 2
    twice = np.bincount(exact)[exact] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base(text: str | None) -> tuple[int, int, int, int, int, np.ndarray, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ids of the words, the words."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    symbols = sum(text.count(c) for c in SYMBOLS)
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    lines: set[str] = set()
    dups = 0
    for line in text.split("\n"):
        if line in lines:
            dups += 1
        elif line.strip(BLANKS):
            lines.add(line)
    return len(words), chars, symbols, dups, repeated_words(ids), ids, words


#: Statistics of a text that the quality rules and the quality classifier judge, in this order.
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "distinct_share", "same_next_share", "bar_share", "stop_share", "bang_share", "longest_word", "lines_per_word")


def features(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """The five base counts, and the values of FEATURES; an empty text has zeros."""
    text = text or ""
    n, chars, symbols, dups, repeats, ids, words = base(text)
    if not n:
        return (0, 0, symbols, dups, 0), [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    lower = int(hist[97:123].sum())
    upper = int(hist[65:91].sum())
    same = int((ids[1:] == ids[:-1]).sum())
    lines = text.count("\n") + 1
    values = [
        float(np.log1p(n)), chars / n, symbols / chars, dups / lines, repeats / n, upper / max(upper + lower, 1), int(hist[48:58].sum()) / chars,
        (int(ids.max()) + 1) / n, same / max(n - 1, 1), int(hist[124]) / n, int(hist[46] + hist[44]) / n, int(hist[33]) / n, float(min(max(map(len, words)), 1000)) ** 0.5, lines / n,
    ]
    return (n, chars, symbols, dups, repeats), values
