"""Simple-8b: unsigned integers packed in 64-bit words of a 4-bit selector and 60 bits of equal-width values.

Selector 0 is the escape: its word holds the index of a value of over 60 bits in a list beside the words. Selectors
1 to 15 pack COUNTS[s] values of WIDTHS[s] bits, the first value in the lowest bits; values after the last one of a
stream are zeros that the stored count cuts off. Both directions work on whole numpy arrays; only the walk from
word to word while encoding is a loop.
"""

from __future__ import annotations

import numpy as np

# The selector table (values a word, bits a value); index 0 is the escape.
COUNTS = np.array([1, 240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
ESCAPE = 0


#: Least width of the table that holds a value, for values below the length of this array (61: none does).
_LIMITS = np.array([1 << int(w) for w in WIDTHS[1:]], dtype=np.uint64)
_LEAST = np.append(WIDTHS[1:], 61).astype(np.int8)
_SMALL = _LEAST[np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right")]


def _least_width(values: np.ndarray) -> np.ndarray:
    if int(values.max()) < len(_SMALL):
        return _SMALL[values]
    return _LEAST[np.searchsorted(_LIMITS, values, side="right")]


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) and escaped values (uint64, in order) of an array of unsigned integers."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    # A selector may begin where none of its word's values is wider than its own; places after the end count as zeros.
    widest = {1: np.concatenate([_least_width(values), np.zeros(240, np.int8)])}  # window length -> widest value from a place on
    for k in (2, 4, 8, 16, 32, 64, 128):
        half = widest[k // 2]
        widest[k] = np.maximum(half[:len(half) - k // 2], half[k // 2:])
    best = np.zeros(n, dtype=np.int8)
    for s in range(15, 0, -1):  # towards more values a word: the last selector that fits wins
        count = int(COUNTS[s])
        part = 1 << (count.bit_length() - 1)
        top = np.maximum(widest[part][:n], widest[part][count - part:count - part + n])
        np.copyto(best, np.int8(s), where=top <= WIDTHS[s].astype(np.int8))
    step = np.minimum(np.arange(n, dtype=np.int64) + COUNTS[best], n).tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i = step[i]
    starts = np.array(starts, dtype=np.int64)
    chosen = best[starts].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(240, np.uint64)])
    for s in range(2, 16):
        at = np.flatnonzero(chosen == s)
        if len(at):
            for j in range(int(COUNTS[s])):
                words[at] |= padded[starts[at] + j] << np.uint64(j * int(WIDTHS[s]))
    out = np.flatnonzero(chosen == ESCAPE)
    words[out] = np.arange(len(out), dtype=np.uint64)
    return words, values[starts[out]]


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values (uint64) of a stream packed by ``pack``."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for s in np.unique(selector):
        here = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[at[here]] = escapes[(words[here] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif s > 1:
            count, width = int(COUNTS[s]), int(WIDTHS[s])
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            out[at[here][:, None] + np.arange(count)] = (words[here][:, None] >> shifts) & np.uint64((1 << width) - 1)
    return out[:n]
