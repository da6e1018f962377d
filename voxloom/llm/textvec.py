"""Vectorised words and word hashing over batches of texts, for operators on words and shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x100000001B3
_STRETCH = 1 << 18

#: Bytes that separate words: white space, or all ASCII but letters and digits.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes by content and length of spans, in order of their start, of whole numbers.

    A prefix sum of value * B**place gives each span times B**start; B is odd, so that
    factor has an inverse modulo 2**64.
    """
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        lo = int(start[at])
        to = max(at + 1, int(np.searchsorted(start, lo + _STRETCH, side="left")))
        s, n = start[at:to] - lo, length[at:to]
        hi = int((s + n).max())
        prefix = np.zeros(hi + 1, dtype=np.uint64)
        np.add.accumulate((values[lo : lo + hi].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, hi)[:hi], out=prefix[1:])
        out[at:to] = (prefix[s + n] - prefix[s]) * _powers(pow(_BASE, -1, 1 << 64), int(s.max()))[s] + n.astype(np.uint64) * _M1
        at = to
    return mix(out)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n consecutive items of a sequence of hashes."""
    k = max(0, len(h) - n + 1)
    out = np.zeros(k, dtype=np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + k]) * _M1
        out ^= out >> np.uint64(31)
    return mix(out)


def find_words(data: np.ndarray, separates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that don't separate; the last byte must."""
    sep = separates[data]
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    if len(sep) and not sep[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def batches_of(texts: Iterable[str | None], most: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes with a line break behind each text, where each text ends) of half a MB each; a longer text is alone."""
    at, row, part, size = 0, 0, [], 0
    for row, t in enumerate(texts):
        b = (t or "").encode("utf-8", "replace") + b"\n"
        if part and size + len(b) > most:
            yield at, np.frombuffer(b"".join(part), np.uint8), np.cumsum([len(x) for x in part])
            at, part, size = row, [], 0
        part.append(b)
        size += len(b)
    if part:
        yield at, np.frombuffer(b"".join(part), np.uint8), np.cumsum([len(x) for x in part])


def words_of(data: np.ndarray, ends: np.ndarray, separates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word; where each text's words end."""
    s, e = find_words(data, separates)
    return s, e, np.searchsorted(s, ends, side="left")
