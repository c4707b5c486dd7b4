"""Rolling hashes of words and bytes over whole Arrow batches, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result hangs on every bit of ``x``."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Prefix sums that give the hash of any substring of a slice in constant time.

    The hash is a polynomial over random values of the bytes, modulo 2**64, with an odd base.
    ``lower`` maps A-Z to a-z.
    """

    _tables: dict = {}

    def __init__(self, seed: int, lower: bool = False):
        key = (seed, lower)
        if key not in self._tables:
            random = np.random.Generator(np.random.PCG64(seed))
            values = random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
            if lower:
                values[65:91] = values[97:123]
            base = int(random.integers(2**40, 2**63)) * 2 + 1
            self._tables[key] = [values, base, pow(base, -1, 2**64), np.ones(1, _U), np.ones(1, _U)]
        self.table = self._tables[key]

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        _, base, inverse, up, down = self.table
        while len(up) < n:
            up = np.concatenate([up, up * _U(pow(base, len(up), 2**64))])
            down = np.concatenate([down, down * _U(pow(inverse, len(down), 2**64))])
        if len(up) <= 4 * SLICE_BYTES:
            self.table[3:] = [up, down]
        return up, down

    def of(self, data: np.ndarray) -> Rolling:
        up, self.down = self._powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(self.table[0][data] * up[: len(data)], out=self.sums[1:])
        return self

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` bytes."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, _U)
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]


def slices(texts: pa.Array, at_most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``at_most`` bytes together: first row, end row, bytes, offsets from 0."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + at_most, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray, at_most: int = 4 * SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, A-Z lower-cased, and where each text's words start.

    Words are runs of bytes outside 0x20 and 0x09-0x0D. A text longer than ``at_most`` is hashed
    in parts that end at a separator, so only its word hashes are held whole.
    """
    if len(data) > at_most and len(offsets) == 2:
        found, start = [], 0
        while start < len(data):
            end = min(start + at_most, len(data))
            while end < len(data) and not _SEPARATOR[data[end]]:
                step = np.flatnonzero(_SEPARATOR[data[end : end + at_most]])
                end = end + int(step[0]) if len(step) else min(end + at_most, len(data))
            found.append(_words(data[start:end], np.array([0, end - start]))[0])
            start = end
        words = np.concatenate(found)
        return words, np.array([0, len(words)])
    return _words(data, offsets)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_SEPARATOR[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False  # no word goes on over the border of two texts
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    rolled = Rolling(11, lower=True).of(data)
    return mix(rolled.hash(starts, ends)), np.searchsorted(starts, offsets)


def shingle_sets(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct ``width``-word shingles.

    With fewer words the whole sequence is the only shingle; without words there is none.
    """
    factors = mix(np.arange(1, width + 1, dtype=_U), 5) | _U(1)
    rolled = np.zeros(max(0, len(words) - width + 1), _U)
    for k in range(width):
        rolled += words[k : k + len(rolled)] * factors[k]
    rolled = mix(rolled)
    out = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        n = end - start
        if n >= width:
            out.append(np.unique(rolled[start : end - width + 1]))
        elif n:
            out.append(mix(np.array([(words[start:end] * factors[:n]).sum() + _U(int(n))], _U), 7))
        else:
            out.append(np.zeros(0, _U))
    return out
