"""Vectorised words, word hashes and rolling phrase hashes over whole texts.

Everything works on the UTF-8 bytes of many texts at once with numpy, so a
task pays a few nanoseconds a byte and no Python call a word. A word is a
maximal run of bytes that a 256-entry table calls "word"; both tables below
classify ASCII bytes only, and every byte of a multi-byte character is a word
byte, so cutting bytes equals cutting code points.

Null texts count as empty. A text never shares a word with its neighbour.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: `[^\x20\x09-\x0D]+`: everything but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: digits, a-z, non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Bytes of text that are worked on at once (one longer text makes its own chunk).
CHUNK_BYTES = 512 << 10

_BASE = 0x9E3779B97F4A7C15 | 1
_PHRASE_BASE = 0xD6E8FEB86659FD93 | 1
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; arithmetic wraps."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(1 << 16, 1 << (n - 1).bit_length()))


def _ranges(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[lo:hi] for each pair of bounds."""
    up, down = _power_tables(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[hi] - total[lo]) * down[lo])


@dataclass
class Words:
    """Words of a run of texts: byte bounds, hashes, and lo[i]:lo[i + 1] for text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    lo: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.lo)

    def phrases(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from every word on, and whether they lie in one text."""
        n = len(self.hashes)
        at = np.arange(n)
        ok = at + k <= np.repeat(self.lo[1:], self.counts)
        out = np.zeros(n, np.uint64)
        if ok.any():
            out[ok] = _ranges(self.hashes, at[ok], at[ok] + k, _PHRASE_BASE)
        return out, ok

    def whole(self) -> np.ndarray:
        """Hash of the whole word sequence of each text."""
        return mix(_ranges(self.hashes, self.lo[:-1], self.lo[1:], _PHRASE_BASE) + self.counts.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def tokenize(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool) -> Words:
    """data: the texts' bytes one after another, offsets[i]:offsets[i + 1] for text i."""
    if lower:
        data = LOWER[data]
    is_word = np.zeros(len(data) + 1, bool)
    is_word[:-1] = table[data]
    first, last = is_word[:-1].copy(), is_word[:-1].copy()
    first[1:] &= ~is_word[:-2]
    last &= ~is_word[1:]
    at = offsets[offsets < len(data)]
    first[at] = is_word[at]
    at = at[at > 0] - 1
    last[at] = is_word[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = _ranges(_BYTES[data], starts, ends, _BASE) if len(starts) else np.zeros(0, np.uint64)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def chunks(texts: pa.Array, most: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about CHUNK_BYTES, `most` texts at most."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, "right")) - 1
        end = min(n, row + most, max(end, row + 1))
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def batches(texts: pa.Array, table: np.ndarray, lower: bool, most: int = 1 << 30) -> Iterator[tuple[int, int, Words]]:
    for row, end, data, offsets in chunks(texts, most):
        yield row, end, tokenize(data, offsets, table, lower)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.astype(np.uint64, copy=False).view(np.int64)
