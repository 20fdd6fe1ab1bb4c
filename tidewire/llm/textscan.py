"""Words and their 64-bit hashes for whole Arrow text columns, by numpy over the UTF-8 bytes.

A word is a run of bytes outside space and 0x09-0x0D. Work goes in slices of about SLICE bytes cut
between words, so memory doesn't follow the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """An avalanche step on uint64 (the public splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE + (SLICE >> 2))
        _powers[:] = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, b, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"").cast(kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return raw, at - at[0]


def _slices(space: np.ndarray, offsets: np.ndarray):
    start, n = 0, len(space)
    while start < n:
        end = min(n, start + SLICE)
        if end < n:
            stop = offsets[np.searchsorted(offsets, end)]  # the end of this text at the latest
            hop = end
            while hop < stop:
                found = np.flatnonzero(space[hop : min(stop, hop + 65536)])
                if len(found):
                    stop = hop + found[0]
                    break
                hop += 65536
            end = int(min(stop, n))
        yield start, end
        start = end


_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: For words of letters and digits only: every ASCII byte but those separates.
_PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, bounds): the words of text i are hashes[bounds[i]:bounds[i+1]].
    With lower, A-Z count as a-z."""
    (hashes,), bounds = word_parts(column, lower)
    return hashes, bounds


def word_slices(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, prefixes: tuple[int, ...] = (), letters: bool = False):
    """For each slice of texts' bytes: the hashes of its words, those of their first n bytes for each n (0 where a word
    is shorter), and where the words start and end."""
    space = (_PUNCTUATION if letters else _SPACE)[raw]
    for a, b in _slices(space, offsets):
        part = raw[a:b]
        if lower:
            part = np.where((part >= 65) & (part <= 90), part | 32, part)
        word = ~space[a:b]
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        inner = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
        opens[inner] = word[inner]  # a text begins: so does a word
        closes = word.copy()
        closes[:-1] &= ~word[1:] | opens[1:]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        up, down = _power_tables(b - a + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
            base, back = total[s], down[s]
            hashes = [mix((total[e] - base) * back + (e - s).astype(np.uint64))]
            for n in prefixes:
                stop = np.minimum(s + n, e)
                hashes.append(np.where(e - s >= n, mix((total[stop] - base) * back + np.uint64(1 << 40) * np.uint64(n)), np.uint64(0)))
        yield hashes, s + a, e + a


def word_parts(column: pa.Array, lower: bool = True, prefixes: tuple[int, ...] = (), letters: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """([hashes of words, hashes of their first n bytes for each n], bounds); a word shorter than n
    has 0 there. With letters, words are runs of letters and digits (and bytes above 127)."""
    raw, offsets = text_bytes(column)
    found = list(word_slices(raw, offsets, lower, prefixes, letters))
    if not found:
        return [np.empty(0, np.uint64) for _ in (0, *prefixes)], np.zeros(len(offsets), np.int64)
    return [np.concatenate(x) for x in zip(*(hashes for hashes, _, _ in found), strict=True)], np.searchsorted(np.concatenate([s for _, s, _ in found]), offsets)
