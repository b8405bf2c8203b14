"""Operator 7: byte-pair encoding and decoding with a pair occurrence index.

The distinct words of a part of a partition are laid out in one array of symbols. An index
maps the rank of each adjacent pair to the positions where it stands; ranks are applied in
ascending order to all their positions, and a merge moves the pairs to its left and right
to other lists. Where a merge may open a lower rank, only the first of each word is merged
before the lists are asked again, so every word ends as if it had been merged alone. Texts
are split at white space first, since no word crosses it.

NULL and empty texts have no tokens and decode to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import pickle
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import share

# stretches kept with their tokens; beyond it only those of the texts at hand stay
KEPT_STRETCHES = 100_000
# characters looked at together
CHUNK_CHARS = 1_000_000


@dataclass(frozen=True)
class BpeModel:
    """Fixed tables of a tokenizer; their size is that of the vocabulary file."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    pattern: str
    suffix: str
    special: dict[str, int]

    @staticmethod
    def from_file(path: str) -> BpeModel:
        """Read a `tokenizers` file: BPE over bytes, NFC, lower case, one split pattern."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unsupported tokenizer file: {path}")
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or spec["decoder"] is not None:
            raise ValueError(f"unsupported tokenizer file: {path}")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return BpeModel(
            vocab=model["vocab"],
            merges=merges,
            pattern=steps[0]["pattern"]["Regex"],
            suffix=model["end_of_word_suffix"] or "",
            special={t["content"]: t["id"] for t in spec["added_tokens"]},
        )


def byte_symbols() -> list[str]:
    """Printable stand-in of each byte: itself where printable, else 256 and up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTable:
    """Rank and merged symbol of each pair, in arrays sorted by pair."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        first, second = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        self.first, self.second = first, second
        self.merged = np.array(merged, dtype=np.int64)
        keys = first << 32 | second
        # of two rules for one pair, the later stands
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # ranks whose merge can open a pair of a lower rank
        lowest = np.full(int(max(first.max(), second.max(), self.merged.max())) + 1, len(keys))
        np.minimum.at(lowest, first, np.arange(len(keys)))
        np.minimum.at(lowest, second, np.arange(len(keys)))
        self.early = lowest[self.merged] < np.arange(len(keys))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for those that never merge."""
        keys = a << 32 | b
        at = np.searchsorted(self.keys, keys, side="right") - 1
        return np.where((at >= 0) & (self.keys[at] == keys), self.order[at], -1)


class PairIndex:
    """Symbols of many words in one array, linked left and right, and the pair lists."""

    def __init__(self, table: PairTable, symbols: np.ndarray, sizes: np.ndarray):
        self.table = table
        n = len(symbols)
        ends = np.cumsum(sizes)
        self.symbol = symbols.astype(np.int64)
        self.word = np.repeat(np.arange(len(sizes)), sizes)
        self.right = np.arange(1, n + 1)
        self.right[ends - 1] = -1
        self.left = np.arange(-1, n - 1)
        self.left[ends - sizes] = -1
        at = np.flatnonzero(self.right >= 0)
        ranks = table.ranks(self.symbol[at], self.symbol[at + 1])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
        #: rank -> its positions, ascending
        self.places: dict[int, np.ndarray] = dict(
            zip(ranks[cuts].tolist(), np.split(at, cuts[1:]) if len(at) else [])
        )
        self.opened: dict[int, list[int]] = {}
        self.active = sorted(self.places)

    def merge_all(self) -> None:
        """Apply the active ranks in ascending order, each to all of its positions."""
        table, symbol, right = self.table, self.symbol, self.right
        while self.active:
            rank = heapq.heappop(self.active)
            at = self.places.pop(rank, None)
            if rank in self.opened:
                more = np.array(self.opened.pop(rank))
                at = np.unique(more if at is None else np.concatenate((at, more)))
            after = right[at]
            stands = (symbol[at] == table.first[rank]) & (after >= 0)
            at, after = at[stands], after[stands]
            stands = symbol[after] == table.second[rank]
            at, after = at[stands], after[stands]
            if len(at) > 1 and table.first[rank] == table.second[rank]:
                # a run of one symbol pairs up from its left: every other position
                start = np.concatenate(([True], after[:-1] != at[1:]))
                index = np.arange(len(at))
                even = (index - np.maximum.accumulate(np.where(start, index, 0))) % 2 == 0
                at, after = at[even], after[even]
            if len(at) > 1 and table.early[rank]:
                # the merge may call for a lower rank first: the first pair of each word
                # now, the rest when the rank comes again
                first = np.concatenate(([True], self.word[at[1:]] != self.word[at[:-1]]))
                self._list([rank] * int((~first).sum()), at[~first].tolist())
                at, after = at[first], after[first]
            if len(at):
                self._merge(int(table.merged[rank]), at, after)

    def _merge(self, merged: int, at: np.ndarray, after: np.ndarray) -> None:
        symbol, left, right = self.symbol, self.left, self.right
        symbol[at] = merged
        symbol[after] = -1
        beyond = right[after]
        right[at] = beyond
        inside = beyond >= 0
        follows, beyond = at[inside], beyond[inside]
        left[beyond] = follows
        before = left[at]
        before = before[before >= 0]
        starts = np.concatenate((follows, before))
        ranks = self.table.ranks(symbol[starts], symbol[right[starts]])
        known = ranks >= 0
        self._list(ranks[known].tolist(), starts[known].tolist())

    def _list(self, ranks: list[int], starts: list[int]) -> None:
        opened = self.opened
        for rank, at in zip(ranks, starts):
            places = opened.get(rank)
            if places is None:
                opened[rank] = [at]
                if rank not in self.places:
                    heapq.heappush(self.active, rank)
            else:
                places.append(at)

    def words(self) -> Iterator[list[int]]:
        """The symbols of each word, in the order given."""
        stands = self.symbol >= 0
        ids, words = self.symbol[stands].tolist(), self.word[stands]
        ends = np.searchsorted(words, np.arange(self.word[-1] + 1 if len(words) else 0), "right")
        first = 0
        for last in ends.tolist():
            yield ids[first:last]
            first = last


class Encoder:
    """Encodes lists of texts; made once per task."""

    def __init__(self, model: BpeModel):
        vocab = model.vocab
        signs = byte_symbols()
        self.inner = np.array([vocab[s] for s in signs])
        self.final = np.array([vocab[s + model.suffix] for s in signs])
        self.table = PairTable(
            [(vocab[a], vocab[b]) for a, b in model.merges], [vocab[a + b] for a, b in model.merges]
        )
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in model.special.items()}
        self.number = {i: str(i) for i in self.token}
        self.pieces = regex.compile(model.pattern).findall
        self.special = model.special
        names = sorted(model.special, key=len, reverse=True)
        split = "(" + "|".join(map(regex.escape, names)) + ")"
        self.split = regex.compile(split).split if names else lambda text: [text]
        # stretch without white space -> its ids, and its tokens, as text
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}

    def _words_of(self, stretch: str) -> list[str]:
        """Words of a stretch; special tokens stand as themselves, marked by a NUL before."""
        if stretch.isascii() and stretch.isalpha():
            return [stretch.lower()]
        out: list[str] = []
        for part in self.split(stretch) if "<" in stretch else (stretch,):
            if part in self.special:
                out.append("\0" + part)
            elif part:
                plain = part
                if not part.isascii():
                    # sigma: no special form at the end of a word
                    plain = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                plain = plain.lower()
                out += self.pieces(plain)
        return out

    def _learn(self, stretches: set[str]) -> None:
        if len(self.ids) > KEPT_STRETCHES:
            again = [s for s in stretches if s in self.ids]
            self.ids = {s: self.ids[s] for s in again}
            self.tokens = {s: self.tokens[s] for s in again}
        new = [s for s in stretches if s not in self.ids]
        if not new:
            return
        words = [self._words_of(s) for s in new]
        distinct = list(set().union(*words))
        number, token = self.number, self.token
        ids_of, tokens_of = {}, {}
        for word, ids in zip(distinct, self._merged(distinct)):
            ids_of[word] = " ".join([number[i] for i in ids])
            tokens_of[word] = " ".join([token[i] for i in ids])
        for stretch, parts in zip(new, words):
            if len(parts) == 1:
                self.ids[stretch], self.tokens[stretch] = ids_of[parts[0]], tokens_of[parts[0]]
            else:
                self.ids[stretch] = " ".join([ids_of[p] for p in parts])
                self.tokens[stretch] = " ".join([tokens_of[p] for p in parts])

    def _merged(self, words: list[str]) -> Iterator[list[int]]:
        special = {w: self.special[w[1:]] for w in words if w[0] == "\0" and w[1:] in self.special}
        blobs = [w.encode() for w in words if w not in special]
        merged: Iterator[list[int]] = iter(())
        if blobs:
            data = np.frombuffer(b"".join(blobs), dtype=np.uint8)
            sizes = np.array([len(b) for b in blobs])
            symbols = self.inner[data]
            last = np.cumsum(sizes) - 1
            symbols[last] = self.final[data[last]]
            index = PairIndex(self.table, symbols, sizes)
            index.merge_all()
            merged = index.words()
        for w in words:
            yield [special[w]] if w in special else next(merged)

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[str, int, str]]:
        """(ids joined by a space, their number, the decoded text) of each text."""
        for first, last in common.slices([len(t or "") for t in texts], CHUNK_CHARS):
            cut = [stretches(t) if t else [] for t in texts[first:last]]
            self._learn(set().union(*cut))
            for parts in cut:
                # every character of a stretch is in some piece, so none has no tokens
                ids = " ".join(map(self.ids.__getitem__, parts))
                tokens = " ".join(map(self.tokens.__getitem__, parts))
                yield ids, ids.count(" ") + 1 if ids else 0, tokens


def stretches(text: str) -> list[str]:
    """Parts between white space; the four separators below are no white space here."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [s for s in regex.split(r"[\s--[\x1c-\x1f]]+", text, flags=regex.V1) if s]
    return text.split()


def _per_text(spark: SparkSession, model: BpeModel, kind: str, row: Callable) -> Callable:
    shared = share(spark, model)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(pickle.loads(shared.value))
        for texts in batches:
            parts = common.text_parts(texts, CHUNK_CHARS)
            yield common.struct_array(kind, ([row(*x) for x in encoder.encoded(p)] for p in parts))

    return run


def encode_text(spark: SparkSession, model: BpeModel, text: Column | str) -> Column:
    """Struct (ids array<int>, decoded string) of a text column."""

    def row(ids: str, n: int, decoded: str):
        return [int(i) for i in ids.split()], decoded

    return _per_text(spark, model, "ids array<int>, decoded string", row)(text)


def encode_digest(spark: SparkSession, model: BpeModel, text: Column | str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256): digests made where the ids are."""

    def row(ids: str, n: int, decoded: str):
        sha = hashlib.sha256
        return n, sha(ids.encode()).hexdigest(), sha(decoded.encode()).hexdigest()

    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _per_text(spark, model, kind, row)(text)


def decode_ids(spark: SparkSession, model: BpeModel, ids: Column | str) -> Column:
    """Text of an array of ids, special tokens included; unknown ids are left out."""
    shared = share(spark, model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = pickle.loads(shared.value)
        token = {i: t for t, i in m.vocab.items()} | {i: t for t, i in m.special.items()}
        for rows in batches:
            yield pd.Series(
                [" ".join([token[i] for i in (r if r is not None else ()) if i in token]) for r in rows],
                dtype=object,
            )

    return run(ids)


def encode_documents(
    docs: DataFrame, model: BpeModel, text_col: str = "text", into: str = "bpe"
) -> DataFrame:
    """The documents with one more column, a struct of ids and decoded text."""
    return docs.withColumn(into, encode_text(docs.sparkSession, model, F.col(f"`{text_col}`")))
