"""Words of many texts at once: spans, hashes and exact comparison on byte arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from .toxicity import _mix

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
LONG = 64  # words beyond so many bytes are compared one by one


def spans(buf: np.ndarray, offs: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, text) of every run of bytes that ``in_word`` marks; texts lie end to end."""
    n = len(buf)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    word = np.zeros(n + 2, bool)
    word[1:-1] = in_word[buf]
    brk = np.zeros(n + 1, bool)
    brk[offs] = True  # a word ends with its text
    start = np.flatnonzero(word[1:-1] & (brk[:n] | ~word[:-2]))
    end = np.flatnonzero(word[1:-1] & (brk[1:] | ~word[2:])) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def _eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as one number each."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def _rounds(start: np.ndarray, size: np.ndarray, most: int):
    """(spans still open, offset, mask of the bytes left) for the first ``most`` bytes of each span, 8 at a time."""
    at = np.arange(len(start))
    for k in range(0, most, 8):
        at = at[size[at] > k]
        if not len(at):
            return
        left = np.minimum(size[at] - k, 8).astype(np.uint64)
        yield at, k, np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, the same wherever the span lies."""
    size = end - start
    h, eights = size.astype(np.uint64), _eights(buf)
    for at, k, mask in _rounds(start, size, LONG):
        h[at] = _mix(h[at] * np.uint64(0x9E3779B97F4A7C15) + (eights[start[at] + k] & mask))
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes())
    return h


def same_bytes(a: np.ndarray, a_start: np.ndarray, size: np.ndarray, b: np.ndarray, b_start: np.ndarray,
               b_size: np.ndarray, long: int | None = LONG) -> np.ndarray:
    """Whether span i of ``a`` (from a_start, size bytes) holds the bytes of span i of ``b``; those of more than
    ``long`` bytes (by default of a word, None: of 1,024) are compared one by one."""
    long = 1024 if long is None else long
    same = size == b_size
    at = np.flatnonzero(same & (size > long))
    for i in at.tolist():
        same[i] = np.array_equal(a[a_start[i]:a_start[i] + size[i]], b[b_start[i]:b_start[i] + size[i]])
    short = np.flatnonzero(same & (size <= long))
    va, vb, differ = _eights(a), _eights(b), np.zeros(len(short), bool)
    a_at, b_at = a_start[short], b_start[short]
    for at, k, mask in _rounds(a_at, size[short], long):
        differ[at] |= ((va[a_at[at] + k] ^ vb[b_at[at] + k]) & mask) != 0
    same[short[differ]] = False
    return same
