"""Operator 8: benchmark passages found through an FM-index of each training shard.

A window is WINDOW consecutive words of a benchmark item, or all words of a shorter item.
A shard is a part of a partition. Words that no item has cannot stand in a window, so the
shard's text is the runs of item words that are long enough, with a separator after each.
Its suffix array gives the transform; a wavelet matrix answers ranks; all windows are
searched backwards at once; occurrences are located from sampled suffix positions, and the
word spans they cover are merged.

NULL and empty texts have no words; an item without words has no window; a NULL item id is
not listed, though its windows count as hits. Repeated ids are listed once.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import share

WINDOW = 10
# bytes of a shard
SHARD = 1_000_000
# bytes of benchmark text searched for together, which bounds what is broadcast at once
BLOCK = 16_000_000
# distance of sampled suffix positions
SAMPLED = 8


@dataclass(frozen=True)
class Phrases:
    """Windows of a block of items as symbols 1, 2, ... of their words."""

    words: np.ndarray  # sorted hashes of the item words
    windows: np.ndarray  # one row each, right-aligned, 0 before a short one
    sizes: np.ndarray
    items: list[list[str]]  # item ids of each window

    @staticmethod
    def from_items(items: list[tuple[str | None, str | None]], window: int) -> Phrases:
        blobs = [b.translate(common.LOWER) for b in common.text_bytes(t for _, t in items)]
        data, offsets = common.pack(blobs)
        starts, ends = common.word_bounds(data, common.IS_BREAK)
        words, symbol = np.unique(common.span_hashes(data, starts, ends), return_inverse=True)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        cuts = np.searchsorted(owner, np.arange(len(items) + 1)).tolist()
        found: dict[tuple, set] = {}
        for i, (item, _) in enumerate(items):
            own = (symbol[cuts[i] : cuts[i + 1]] + 1).tolist()
            for first in range(max(1, len(own) - window + 1) if own else 0):
                ids = found.setdefault(tuple(own[first : first + window]), set())
                if item is not None:
                    ids.add(item)
        table = np.zeros((len(found), window), dtype=np.int64)
        for row, key in zip(table, found):
            row[window - len(key) :] = key
        sizes = np.array([len(key) for key in found], dtype=np.int64)
        return Phrases(words, table, sizes, [sorted(ids) for ids in found.values()])


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit row per level."""

    def __init__(self, sequence: np.ndarray):
        self.depth = max(1, int(sequence.max()).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.depth - 1, -1, -1):
            bit = (sequence >> level & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int((~bit).sum()))
            sequence = np.concatenate((sequence[~bit], sequence[bit]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        first, last = np.zeros_like(ends), ends
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = (symbols >> (self.depth - 1 - level) & 1).astype(bool)
            first = np.where(up, zeros + ones[first], first - ones[first])
            last = np.where(up, zeros + ones[last], last - ones[last])
        return last - first


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """By doubling; the sequence ends in a symbol smaller than all others."""
    n = len(sequence)
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        following = np.zeros(n, dtype=np.int64)
        following[:-step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        changed = np.diff(key[order], prepend=-1) != 0
        new = np.cumsum(changed) - 1
        rank[order] = new
        if new[-1] == n - 1 or step * 2 >= n:
            return order
        step *= 2


class FmIndex:
    """Index of a sequence of positive symbols; 1 is the separator, 0 the end."""

    def __init__(self, sequence: np.ndarray, sampled: int = SAMPLED):
        text = np.concatenate((sequence, [0]))
        order = suffix_array(text)
        self.last = text[order - 1]
        self.ranks = WaveletMatrix(self.last)
        counts = np.bincount(text, minlength=int(text.max()) + 1)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.is_sampled = order % sampled == 0
        self.number = np.cumsum(self.is_sampled) - 1
        self.position = order[self.is_sampled]
        self.size = len(text)

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with each right-aligned pattern: [low, high)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.size)
        highest = len(self.before) - 2
        for back in range(patterns.shape[1]):
            symbol = patterns[:, -1 - back]
            live = np.flatnonzero((back < sizes) & (low < high))
            symbol = symbol[live]
            inside = symbol <= highest
            high[live[~inside]] = low[live[~inside]]
            live, symbol = live[inside], symbol[inside]
            low[live] = self.before[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: step back to a sampled one and count the steps."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        walking = np.flatnonzero(~self.is_sampled[rows])
        while len(walking):
            at = rows[walking]
            symbol = self.last[at]
            rows[walking] = self.before[symbol] + self.ranks.rank(symbol, at)
            steps[walking] += 1
            walking = walking[~self.is_sampled[rows[walking]]]
        return self.position[self.number[rows]] + steps


@dataclass
class ShardHits:
    """Words of a shard's texts, and the occurrences of windows among them."""

    starts: np.ndarray  # byte where each word starts in its text
    ends: np.ndarray
    first_word: np.ndarray  # of each text, and the number of words after the last
    at: np.ndarray  # word where each occurrence starts
    size: np.ndarray  # its words
    window: np.ndarray  # its window, numbered over all blocks


def search_shard(blobs: list[bytes], blocks: Iterator[tuple[int, Phrases]]) -> ShardHits:
    data, offsets = common.pack([b.translate(common.LOWER) for b in blobs])
    starts, ends = common.word_bounds(data, common.IS_BREAK)
    hashes = common.span_hashes(data, starts, ends)
    first_word = np.concatenate((np.searchsorted(starts, offsets), [len(starts)]))
    found = [[np.zeros(0, dtype=np.int64)] * 3]
    for number, phrases in blocks:
        if not len(phrases.sizes) or not len(starts):
            continue
        place = np.searchsorted(phrases.words, hashes)
        place[place == len(phrases.words)] = 0
        symbol = np.where(phrases.words[place] == hashes, place + 1, 0)
        runs = _runs(symbol, first_word, int(phrases.sizes.min()))
        if not len(runs):
            continue
        # symbols from 2, and a separator after each run
        length = runs[:, 1] - runs[:, 0]
        total = np.cumsum(length + 1)
        word = np.arange(total[-1]) + np.repeat(runs[:, 0] - total + length + 1, length + 1)
        sequence = symbol[np.minimum(word, len(symbol) - 1)] + 1
        sequence[total - 1] = 1
        index = FmIndex(sequence)
        patterns = np.where(phrases.windows > 0, phrases.windows + 1, 0)
        low, high = index.search(patterns, phrases.sizes)
        times = high - low
        row = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        window = np.repeat(np.arange(len(times)), times)
        found.append([word[index.locate(row)], phrases.sizes[window], window + number])
    at, size, window = (np.concatenate(x) for x in zip(*found))
    owner = np.repeat(np.arange(len(blobs)), np.diff(first_word))
    base = offsets[owner] if len(starts) else starts
    return ShardHits(starts - base, ends - base, first_word, at, size, window)


def _runs(symbol: np.ndarray, first_word: np.ndarray, least: int) -> np.ndarray:
    """[first, last) of the stretches of item words within a text, `least` words or more."""
    known = symbol > 0
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    text_starts = first_word[:-1][first_word[:-1] < len(symbol)]
    opens[text_starts] = known[text_starts]
    closes = known.copy()
    closes[:-1] &= ~known[1:] | opens[1:]
    runs = np.stack((np.flatnonzero(opens), np.flatnonzero(closes) + 1), axis=1)
    return runs[runs[:, 1] - runs[:, 0] >= least]


def text_hits(hits: ShardHits, items: list[list[str]]) -> Iterator[tuple[int, int, list, list]]:
    """(words, words hit, ids of the items, merged spans as word ranges) of each text."""
    n = len(hits.starts)
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, hits.at, 1)
    np.add.at(cover, hits.at + hits.size, -1)
    hit = np.cumsum(cover)[:-1] > 0
    total = np.concatenate(([0], np.cumsum(hit)))
    text = np.searchsorted(hits.first_word, hits.at, side="right") - 1
    of_text: dict[int, set] = {}
    for t, w in zip(text.tolist(), hits.window.tolist()):
        of_text.setdefault(t, set()).update(items[w])
    for t, (first, last) in enumerate(zip(hits.first_word[:-1].tolist(), hits.first_word[1:].tolist())):
        spans = []
        if total[last] > total[first]:
            inside = np.concatenate(([0], hit[first:last].astype(np.int8), [0]))
            edges = np.flatnonzero(np.diff(inside))
            spans = list(zip((edges[0::2] + first).tolist(), (edges[1::2] + first).tolist()))
        yield last - first, int(total[last] - total[first]), sorted(of_text.get(t, ())), spans


class Benchmark:
    """The items in blocks of bounded size, each broadcast by itself."""

    def __init__(
        self,
        items: DataFrame,
        window: int = WINDOW,
        item_col: str = "item_id",
        text_col: str = "text",
        block: int = BLOCK,
    ):
        spark = items.sparkSession
        rows = items.select(
            F.col(f"`{item_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t")
        ).where(F.col("t").isNotNull())
        size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        blocks = int(size // block) + 1
        self.shared, self.first = [], [0]
        for b in range(blocks):
            part = rows.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect()
            phrases = Phrases.from_items([(r["i"], r["t"]) for r in part], window)
            self.shared.append(share(spark, phrases))
            self.first.append(self.first[-1] + len(phrases.sizes))


def _per_text(benchmark: Benchmark, kind: str, row: Callable) -> Callable:
    shared, numbers = benchmark.shared, benchmark.first

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = [ids for s in shared for ids in pickle.loads(s.value).items]

        def searched(part: list[str | None]) -> list[tuple]:
            blobs = common.text_bytes(part)
            hits = search_shard(blobs, zip(numbers, (pickle.loads(s.value) for s in shared)))
            return [row(b, hits, *found) for b, found in zip(blobs, text_hits(hits, items))]

        for texts in batches:
            yield common.struct_array(kind, map(searched, common.text_parts(texts, SHARD)))

    return run


def hit_digest(benchmark: Benchmark, text: Column | str) -> Column:
    """Struct (n_words, n_hit, n_items, items_sha256)."""

    def row(blob, hits, n, hit, ids, spans):
        return n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()

    kind = "n_words long, n_hit long, n_items long, items_sha256 string"
    return _per_text(benchmark, kind, row)(text)


def hit_spans(benchmark: Benchmark, text: Column | str) -> Column:
    """Struct (items, spans, kept): ids, word ranges, and the text without the spans."""

    def row(blob, hits, n, hit, ids, spans):
        first = int(hits.first_word[0])
        kept, at = [], 0
        for start, end in spans:
            kept.append(blob[at : hits.starts[start]])
            at = int(hits.ends[end - 1])
        kept.append(blob[at:])
        return ids, [str((s - first, e - first)) for s, e in spans], b"".join(kept).decode()

    return _per_text(benchmark, "items array<string>, spans array<string>, kept string", row)(text)


def contaminated(spark: SparkSession, benchmark: Benchmark, text: Column | str) -> Column:
    """True where any window of the benchmark occurs."""
    return hit_digest(benchmark, text)["n_hit"] > 0
