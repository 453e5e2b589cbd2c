"""Words of a batch of texts as 64-bit hashes, without a Python object per word.

Texts arrive as an Arrow column. Byte values are turned to 64-bit numbers and every word is a
polynomial over its bytes, read off running sums modulo 2**64; runs of words are hashed the same
way over the words' hashes. A final mix spreads the bits. Hashes depend on the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT_BYTES = 1 << 17  # words are hashed in segments of about this many bytes (they stay in cache)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_CODES = {False: _BYTES, True: _BYTES[_LOWER]}
# White space that parts words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, made by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    step, have = U(base), 1
    with np.errstate(over="ignore"):
        while have < n:
            more = min(have, n - have)
            out[have : have + more] = out[:more] * step
            step, have = step * step, have + more
    return out[:n]


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = _powers(self.base, n + n // 4), _powers(self.inverse, n + n // 4)
        return self.up[:n], self.down[:n]


_LETTERS, _RUNS = Powers(0x9E3779B97F4A7C15 | 1), (Powers(0xD1B54A32D192ED03), Powers(0x8CB92BA72F3D8DD7))


def _spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """The polynomial of codes[start:end] for every span, alike wherever the span lies."""
    up, down = powers.upto(len(codes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=total[1:])
        return (total[ends] - total[starts]) * down[starts]


class Words:
    """The words of a column of texts: hashes, byte ranges, and each text's range of words."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        first = int(offsets[0]) if len(offsets) else 0
        last = int(offsets[-1]) if len(offsets) else 0
        self.data, at = data[first:last], offsets - first
        self.byte_counts = np.diff(at)
        inside = ~SPACE[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        bounds = at[1:-1]
        bounds = bounds[(bounds > 0) & (bounds < len(self.data))]
        opens[bounds] = inside[bounds]
        closes[bounds - 1] = inside[bounds - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, at)  # word range of text k: first[k] to first[k + 1]
        self.counts = np.diff(self.first)
        self.hashes = np.empty(len(self.starts), np.uint64)
        codes, a = BYTE_CODES[lower], 0
        while a < len(self.starts):
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + SEGMENT_BYTES)))
            low = self.starts[a]
            part = _spans(codes[self.data[low : self.ends[b - 1]]], self.starts[a:b] - low, self.ends[a:b] - low, _LETTERS)
            self.hashes[a:b] = mix(part + (self.ends[a:b] - self.starts[a:b]).astype(np.uint64))
            a = b

    def runs(self, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(hash, starting word) of every run of ``size`` words inside one text."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)  # words from here to the text's end
        at = np.flatnonzero(left >= size)
        return mix(_spans(self.hashes, at, at + size, _RUNS[which])), at

    def whole(self, k: int, which: int = 0) -> int:
        """The hash of all words of text ``k``."""
        a, b = int(self.first[k]), int(self.first[k + 1])
        return int(mix(_spans(self.hashes[a:b], np.array([0]), np.array([b - a]), _RUNS[which]))[0])

    def text_of(self, words: np.ndarray) -> np.ndarray:
        """The text that each word belongs to."""
        return np.searchsorted(self.first, words, side="right") - 1

    def joined(self, k: int, keep: np.ndarray | None = None) -> bytes:
        """The words of text ``k`` (those marked in ``keep``) joined by one space."""
        a, b = int(self.first[k]), int(self.first[k + 1])
        if a == b:
            return b""
        raw = self.data[self.starts[a] : self.ends[b - 1]].tobytes().split()
        return b" ".join(raw if keep is None else [w for w, good in zip(raw, keep, strict=True) if good])
