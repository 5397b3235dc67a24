"""Words and word windows of many texts at once, on the bytes of an Arrow column.

A word is ``[^\\x20\\x09-\\x0D]+``. Everything is vectorised over slices of a few megabytes, so memory does not depend
on the batch, and a text of any length is taken whole. Hashes are 64-bit polynomials over random byte values, made
independent of the place of the word and mixed; they are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: _Powers) -> np.ndarray:
    """Hash of values[start:end] for every pair."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class Texts:
    """Some texts side by side: ``data`` bytes, text i at bounds[i]:bounds[i+1], its words at first[i]:first[i+1]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        gap = SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.empty(len(data), bool)
        if len(data):
            before[0] = True
            np.logical_or(gap[:-1], edge[1:-1], out=before[1:])
        self.start = np.flatnonzero(~gap & before)
        after = np.empty(len(data), bool)
        if len(data):
            after[-1] = True
            np.logical_or(gap[1:], edge[1:-1], out=after[:-1])
        self.end = np.flatnonzero(~gap & after) + 1
        self.first = np.searchsorted(self.start, bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return self.span_hashes(self.start, self.end, lower)

    def span_hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """Hashes of byte spans that lie inside one text each."""
        table = BYTE_VALUE[LOWER] if lower else BYTE_VALUE
        return _spans(table[self.data], start, end, _BYTES)

    def words_of(self) -> np.ndarray:
        """The text every word belongs to."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def windows(self, n: int) -> np.ndarray:
        """Word numbers at which a window of n words of one text starts."""
        number = np.arange(len(self.start))
        return number[number + n <= np.repeat(self.first[1:], np.diff(self.first))]


def window_hashes(words: np.ndarray, at: np.ndarray, n) -> np.ndarray:
    """Hashes of ``n`` words (a number, or one for each) from the given word numbers on."""
    return _spans(words, at, at + n, _WORDS)


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """(number of the first text, texts) in slices of about ``size`` bytes; nulls are empty texts."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if chunk.type == pa.large_string():
            wide = np.frombuffer(chunk.buffers()[1], np.int64)
        else:
            wide = np.frombuffer(chunk.buffers()[1], np.int32) if chunk.buffers()[1] else np.zeros(1, np.int32)
        bounds = wide[chunk.offset:chunk.offset + len(chunk) + 1].astype(np.int64)
        data = np.frombuffer(chunk.buffers()[2], np.uint8) if chunk.buffers()[2] else np.zeros(0, np.uint8)
        if chunk.null_count:  # a null may lie over bytes that count for nothing
            keep = np.asarray(chunk.is_valid())
            if (np.diff(bounds)[~keep] != 0).any():
                yield from slices(chunk.fill_null(""), size)
                continue
        at = 0
        while at < len(chunk):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            yield at, Texts(data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at])
            at = to


