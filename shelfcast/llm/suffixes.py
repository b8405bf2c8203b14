"""Suffix arrays in numpy, common prefixes of neighbours, and merging by binary search."""

from __future__ import annotations

import numpy as np


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position and the end on, read from the bytes themselves."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, little-endian, zeros beyond the end."""
    return _eight(data)[:-1].astype(np.uint64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order, a suffix before those that go on after it.

    Larsson-Sadakane refinement: ranks by eight bytes first; each round doubles the prefix
    by the rank that far ahead, and sorts only the groups that are still tied. Up to two million
    bytes, a suffix fits into one value with both its ranks, and values are sorted in place.
    """
    n = len(data)
    first = words_at(data).byteswap()
    order = np.argsort(first)
    # rank: one and the place of the first suffix of the group, 0 for the empty one at the end;
    # ranks of four bytes are read faster
    rank = np.zeros(n + 1, dtype=np.int32 if n < 1 << 30 else np.int64)
    ordered = first[order]
    opens = np.ones(n, dtype=bool)
    opens[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(opens)
    sizes = np.diff(starts, append=n)
    rank[order] = np.repeat(starts + 1, sizes)
    known, bits = 8, n.bit_length()
    while known < n:
        # places of the groups with more than one member
        tied = sizes > 1
        starts, sizes = starts[tied], sizes[tied]
        places = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        places += np.arange(len(places))
        if not len(places):
            break
        members = order[places]
        following = rank[np.minimum(members + known, n)].astype(np.uint64)
        own = np.repeat(starts.astype(np.uint64) << np.uint64(bits), sizes)
        members, key = _by_ranks(members, own | following, bits)
        order[places] = members
        opens = np.ones(len(key), dtype=bool)
        opens[1:] = key[1:] != key[:-1]
        starts = places[opens]
        sizes = np.diff(np.flatnonzero(opens), append=len(places))
        rank[members] = np.repeat(starts + 1, sizes)
        known *= 2
    return order


def _by_ranks(members: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Members in order of a key of two ranks, and their keys."""
    if 3 * bits > 64:
        inner = np.argsort(key)
        return members[inner], key[inner]
    key <<= np.uint64(bits)
    key |= members.astype(np.uint64)
    key.sort()
    return (key & np.uint64((1 << bits) - 1)).astype(members.dtype), key >> np.uint64(bits)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, lane: int = 64) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to `most` or a bit over.

    Kasai's rule: a suffix shares at least one byte less with its neighbour than the suffix
    one byte longer did with its own. The text is cut into lanes that advance together; what
    they read and write in one step lies together.
    """
    n = len(data)
    words = _eight(data)
    heads = np.arange(0, n, lane)
    small = np.int32 if n < 1 << 30 else np.int64
    before = np.full(len(heads) * lane, -1, dtype=small)
    before[order[1:]] = order[:-1]
    before = np.ascontiguousarray(before.reshape(-1, lane).T)
    shared = np.zeros((lane, len(heads)), dtype=small)
    length = np.zeros(len(heads), dtype=np.int64)
    for step in range(min(lane, n)):
        at, other = heads + step, before[step]
        # places beyond the end have nothing before them
        length = np.where(other < 0, 0, np.maximum(length - 1, 0))
        going = np.flatnonzero((other >= 0) & (length < most))
        while len(going):
            p, q = at[going] + length[going], other[going] + length[going]
            differ = words[p] ^ words[q]
            # the bits below the lowest one that differs
            same = np.bitwise_count((differ - np.uint64(1)) & ~differ) >> 3
            room = n - np.maximum(p, q)
            length[going] += np.minimum(same, room)
            going = going[(same == 8) & (room > 8) & (length[going] < most)]
        shared[step] = length
    return shared.T.ravel()[order]


def merge_least(shards: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For shards of (sorted distinct strings, number): the least number of each over all.

    Each shard is searched for in the merged strings so far; new ones are inserted.
    """
    strings, least = shards[0][0], shards[0][1].copy()
    for new, numbers in shards[1:]:
        at = np.searchsorted(strings, new)
        found = strings[np.minimum(at, len(strings) - 1)] == new
        np.minimum.at(least, at[found], numbers[found])
        strings = np.insert(strings, at[~found], new[~found])
        least = np.insert(least, at[~found], numbers[~found])
    return [least[np.searchsorted(strings, own)] for own, _ in shards]
