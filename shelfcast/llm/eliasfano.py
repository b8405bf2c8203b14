"""Monotone integer sequences in Elias-Fano form, and n-gram tries of them."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_ONE = np.uint64(1)
_HALVES = (32, 16, 8, 4, 2, 1)


class EliasFano:
    """n non-decreasing values below `universe`: low bits packed, high bits in unary.

    Searches are vectorised: the high bits give the range of values that share them, by
    selecting zeros; the low bits are searched within that range.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        # zeros before each word of the unary part
        zeros = 64 - np.bitwise_count(high).astype(np.int64)
        self.zeros = np.cumsum(zeros) - zeros
        # the last bits of the last word are no zeros of the sequence, but lie behind all

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high_part = (values >> np.uint64(low_bits)).astype(np.int64)
        ones = high_part + np.arange(n)
        size = n + (universe >> low_bits) + 2
        bits = np.zeros((size + 63) // 64 * 64, dtype=np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        return EliasFano(n, low_bits, _pack(values, low_bits), high)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=np.uint64)
        at = index * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.low[word] >> shift
        # a shift by 64 is made in two steps
        second = (self.low[word + 1] << (np.uint64(63) - shift)) << _ONE
        return (first | second) & np.uint64((1 << self.low_bits) - 1)

    def _select_zero(self, rank: np.ndarray) -> np.ndarray:
        """Position of the zero with that number, from 0."""
        word = np.searchsorted(self.zeros, rank, side="right") - 1
        left = rank - self.zeros[word]
        bits = ~self.high[word]
        at = word << 6
        for width in _HALVES:
            part = bits & np.uint64((1 << width) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            beyond = left >= count
            left = np.where(beyond, left - count, left)
            bits = np.where(beyond, bits >> np.uint64(width), part)
            at = np.where(beyond, at + width, at)
        return at

    def _range(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past the last index of the values with these high bits."""
        if len(high) < len(self.high):
            end = self._select_zero(high) - high
            first = np.where(high > 0, self._select_zero(np.maximum(high - 1, 0)) - high + 1, 0)
            return first, end
        # many: all zeros are selected at once
        zeros = np.flatnonzero(np.unpackbits(~self.high.view(np.uint8), bitorder="little"))
        ends = np.concatenate(([0], zeros - np.arange(len(zeros))))
        return ends[high], ends[high + 1]

    def _parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        return high, x & np.uint64((1 << self.low_bits) - 1)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value that is x or more."""
        high, low = self._parts(x)
        return self._search(low, *self._range(high))

    def _search(self, low: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Index of the first value within each range whose low bits are so high, or its end."""
        first, last = first.copy(), last.copy()
        while len(going := np.flatnonzero(first < last)):
            middle = (first[going] + last[going]) >> 1
            less = self._low(middle) < low[going]
            first[going] = np.where(less, middle + 1, first[going])
            last[going] = np.where(less, last[going], middle)
        return first

    def value(self, index: np.ndarray) -> np.ndarray:
        """The values at some places."""
        ones = 64 - np.diff(self.zeros, append=self.zeros[-1] + 64 - _count(self.high[-1:])[0])
        before = np.cumsum(ones) - ones
        word = np.searchsorted(before, index, side="right") - 1
        left, bits, at = index - before[word], self.high[word], word << 6
        for width in _HALVES:
            part = bits & np.uint64((1 << width) - 1)
            count = _count(part)
            beyond = left >= count
            left = np.where(beyond, left - count, left)
            bits = np.where(beyond, bits >> np.uint64(width), part)
            at = np.where(beyond, at + width, at)
        high = (at - index).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(index)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it does not occur."""
        high, low = self._parts(x)
        first, end = self._range(high)
        index = self._search(low, first, end)
        inside = index < end
        at = np.minimum(index, max(self.n - 1, 0))
        return np.where(inside & (self._low(at) == low), index, -1) if self.n else at * 0 - 1


def _count(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest bits of each value, one after another, and a spare word."""
    if not width:
        return np.zeros(1, dtype=np.uint64)
    n = len(values)
    out = np.zeros(n * width // 64 + 3, dtype=np.uint64)
    at = np.arange(n, dtype=np.int64) * width
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    low = values & np.uint64((1 << width) - 1)
    np.bitwise_or.at(out, word, low << shift)
    np.bitwise_or.at(out, word + 1, (low >> (np.uint64(63) - shift)) >> _ONE)
    return out


class Trie:
    """Runs of symbols, one level for each place in them, and a code for each run, in mapped
    memory.

    Every level holds its symbols relative to their context, the run before them: the place
    of the context in the level above, then the symbol's bits, which keeps the level monotone.
    Pointers give where the successors of each context begin.
    """

    def __init__(
        self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray, codes, bits: int = 32
    ):
        self._build([(contexts, bits), (successors, bits)], [sizes], codes)

    @classmethod
    def of(cls, symbols: list[np.ndarray], bits: list[int], codes: np.ndarray) -> Trie:
        """Of distinct sorted runs: the symbols of each place, and their bits."""
        n = len(codes)
        levels, opens = [], np.zeros(n, dtype=bool)
        firsts = []
        for symbol, width in zip(symbols, bits):
            opens = opens.copy()
            opens[:1] = True
            opens[1:] |= symbol[1:] != symbol[:-1]
            firsts.append(np.flatnonzero(opens))
            levels.append((symbol[firsts[-1]], width))
        # how many runs of the next level begin with each run of this one
        sizes = [
            np.diff(np.searchsorted(below, above), append=len(below))
            for above, below in zip(firsts, firsts[1:])
        ]
        trie = cls.__new__(cls)
        trie._build(levels, sizes, codes)
        return trie

    def _build(self, levels: list[tuple[np.ndarray, int]], sizes: list[np.ndarray], codes) -> None:
        self.bits = [np.uint64(bits) for _, bits in levels]
        parts = [EliasFano.encode(levels[0][0], 1 << levels[0][1])]
        for (symbols, bits), size in zip(levels[1:], sizes):
            place = np.repeat(np.arange(len(size), dtype=np.uint64), size)
            level = place << np.uint64(bits) | symbols.astype(np.uint64)
            pointers = np.concatenate(([0], np.cumsum(size)))
            parts.append(EliasFano.encode(pointers, int(pointers[-1]) + 1))
            parts.append(EliasFano.encode(level, max(1, len(size)) << bits))
        arrays = [a for p in parts for a in (p.low, p.high)] + [np.asarray(codes, dtype=np.uint8)]
        # the file has no name: it goes with the process, and leaves nothing on the machine
        with tempfile.TemporaryFile() as file:
            for a in arrays:
                file.write(a.tobytes() or b"\0")
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, mapped = 0, []
        for a in arrays:
            mapped.append(np.frombuffer(self._map, dtype=a.dtype, count=len(a), offset=at))
            at += len(a.tobytes()) or 1
        coded = [
            EliasFano(p.n, p.low_bits, mapped[2 * i], mapped[2 * i + 1]) for i, p in enumerate(parts)
        ]
        self.levels, self.pointers = coded[:1] + coded[2::2], coded[1::2]
        self.codes = mapped[-1]

    def codes_of(self, *symbols: np.ndarray) -> np.ndarray:
        """Code of each run, 0 for those not in the trie; fastest for runs in order."""
        known = np.arange(len(symbols[0]))
        place = np.zeros(len(known), dtype=np.int64)
        for level, bits, symbol in zip(self.levels, self.bits, symbols):
            asked = place.astype(np.uint64) << bits | symbol[known].astype(np.uint64)
            # neighbours often begin alike, and are looked up once
            new = np.ones(len(asked), dtype=bool)
            new[1:] = asked[1:] != asked[:-1]
            found = level.find(asked[new])[np.cumsum(new) - 1]
            known, place = known[found >= 0], found[found >= 0]
        out = np.zeros(len(symbols[0]), dtype=np.uint8)
        out[known] = self.codes[place]
        return out
