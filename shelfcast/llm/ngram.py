"""Operator 2: scores of whole texts under an n-gram model kept in Elias-Fano tries.

The model has order two or three. Tokens are words and one end per text; the context of the
first is a start mark. With c the counts of the training texts, N their tokens and V the
distinct ones, a word alone has p(w) = (c(w)+0.1)/(N+0.1(V+1)), and after contexts

    p(w|v) = (c(v,w) + MASS * p(w)) / (c(v) + MASS)
    p(w|u,v) = (c(u,v,w) + MASS * p(w|v)) / (c(u,v) + MASS)

The first token of a text has the start mark only before it, and p(w|v) in either order.

The tries hold p(w|v) of every pair and p(w|u,v) of every triple of the training texts, rounded
down to eighths of a power of two (and c(w) and p(w|v) in it likewise). What is not there, or
whose p is rounded below it, has MASS * p(w) / (c(v) + MASS) or MASS * p(w|v) / (c(u,v) + MASS),
which needs no trie. Since nothing is rounded up, the probabilities after a context are positive
and sum to one at most, so every score is the logarithm of a probability.

Texts are dealt into shards by id. Every distinct word is counted in one bucket, and every
distinct pair and triple in another: pairs by their context, triples by their middle word, which
are split into parts, by the word beside them, where they occur more than SPLIT times; so a
frequent one is spread over many buckets. A shard asks for its words first, and sends what it
then knows of them along with its pairs, and what it knows of these along with its triples, so
that a bucket can smooth without a table of words or pairs. The bucket builds a trie of what it
is sent and answers each shard with the codes of what it asked for; nothing is broadcast, no part
of the model is on the driver, and all counts cover all training texts. A triple whose first or
last pair is in no other shard is not sent: the shard has all its counts, and keeps it in a trie
of its own.

Words are told apart by 48 bits in their bucket, within a shard by 64. Pairs have 16 bits of the context and 32 bits of a hash of
the pair, so that one is taken for another of its context's SPLIT in a bucket at most once in
2^17 cases. Triples have 16 bits of the middle word, 16 of a hash of the first pair, and 24 of
one of all three, within a shard as well: one is taken for another of the k of its first pair in
a bucket in k of 2^24 cases.
NULL texts are empty: their one token is the end. Texts whose training flag is NULL do not
train. Without training texts every probability is one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.eliasfano import Trie

SHARD = 4_000_000
MASS = 300.0
SPLIT = 1 << 15
# marks that no word hashes to but by chance
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
# bytes of a count on its way: of a shard or part, and of all texts
PART_BYTES, COUNT_BYTES = 4, 6
# bits by which a trie's levels tell their symbols apart: pairs, triples
BITS = {1: [16, 32], 2: [16, 16, 24]}
_HALF = np.uint64((1 << 16) - 1)
# bits of a word's hash that are sent
_WORD = np.uint64((1 << 48) - 1)
_ASKED = ["shard", "bucket", "keys", "counts", "contexts", "lower", "floor"]
_ANSWER = ["shard", "bucket", "step", "body", "count", "tokens", "distinct"]


def tokens(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of all texts, and the number of tokens of each text."""
    data, offsets = common.pack([b.translate(common.LOWER) for b in blobs])
    starts, ends = common.word_bounds(data, common.IS_SPACE)
    row = np.searchsorted(offsets, starts, side="right") - 1
    counts = np.bincount(row, minlength=len(blobs)) + 1
    out = np.full(len(starts) + len(blobs), END)
    out[np.arange(len(starts)) + row] = common.word_hashes(data, starts, ends)
    return out, counts


def by_bucket(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, last) of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return list(zip(bucket[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]))


def _word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((common.mix(words) >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _in_buckets(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words ordered by bucket and value, their buckets, and the place of each word."""
    distinct, first, place = _unique(words)
    bucket, key, where, _ = _distinct(_word_bucket(distinct, buckets), distinct & _WORD, 48)
    return key, bucket, where[place]


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and the number of each value."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def split(keys: np.ndarray, bits: list[int]) -> list[np.ndarray]:
    """The symbols of keys, which lie one after another with the last one lowest."""
    out = []
    for width in reversed(bits):
        out.append(keys & np.uint64((1 << width) - 1))
        keys = keys >> np.uint64(width)
    return out[::-1]


def _distinct(bucket: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Distinct (bucket, key) in order, the place of each given one, and one of each."""
    if bits <= 48 and len(bucket) and bucket.max() < 1 << 16:
        # both fit in one value
        joint, first, place = _unique(bucket.astype(np.uint64) << np.uint64(48) | key)
        return (joint >> np.uint64(48)).astype(np.int64), joint & _WORD, place, first
    order = np.argsort(key)
    # few buckets fit in two bytes, which are sorted faster
    small = bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket
    order = order[np.argsort(small[order], kind="stable")]
    ordered, buckets = key[order], bucket[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (buckets[1:] != buckets[:-1]) | (ordered[1:] != ordered[:-1])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    first = order[new]
    return buckets[new], ordered[new], place, first


def _spread(context: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each part of a context."""
    spread = common.mix(context + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((spread >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _part(word: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Part of a context that occurs `count` times, by the word beside it."""
    return word % (1 + count // size).astype(np.uint64)


class Pairs:
    """Distinct pairs of a shard by bucket, and the place of each token's pair among them."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, context: np.ndarray, buckets: int, split: int):
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[starts] = START
        mixed = common.mix(before)
        # hash of the whole pair, of which a triple's is made
        self.hash = common.mix(mixed + words)
        bucket = _spread(mixed, _part(words, context, split), buckets)
        key = (mixed & _HALF) << np.uint64(BITS[1][1]) | self.hash >> np.uint64(64 - BITS[1][1])
        self.bucket, self.key, self.place, self.first = _distinct(bucket, key, sum(BITS[1]))


def quantise(counts: np.ndarray) -> np.ndarray:
    """Code of a count: one and its logarithm in whole eighths of a power of two, 0 for 0."""
    logs = np.floor(8 * np.log2(np.maximum(counts, 1)))
    return np.where(counts > 0, np.minimum(1 + logs, 255), 0).astype(np.uint8)


def quantised(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, np.exp2((codes.astype(np.float64) - 1) / 8), 0.0)


def probability_codes(p: np.ndarray) -> np.ndarray:
    """One and the negative logarithm, up to a whole eighth of a power of two; 0 from 2^-31.75 on."""
    codes = 1 + np.ceil(-8 * np.log2(p))
    return np.where(codes < 255, codes, 0).astype(np.uint8)


def probabilities(codes: np.ndarray) -> np.ndarray:
    """What a code stands for, never more than the probability it was made of."""
    return np.where(codes > 0, np.exp2((1 - codes.astype(np.float64)) / 8), 0.0)


def _sorted(values: np.ndarray, runs: list[tuple[int, int]]) -> list[bytes]:
    """Runs of ascending values as differences."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    opens = [i for i, j in runs if i < j]
    steps[opens] = values[opens]
    return common.squeeze_runs(steps, values.dtype.itemsize, runs)


def _unsorted(blobs: pd.Series) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The values of all runs, and where each run lies among them."""
    steps, counts = common.spread_runs(blobs, 8, np.uint64)
    lasts = np.cumsum(counts)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(steps, dtype=np.uint64)))
    values = sums[1:] - np.repeat(sums[lasts - counts], counts)
    return values, list(zip((lasts - counts).tolist(), lasts.tolist()))


def _unpacked(blobs, width: int, kind) -> np.ndarray:
    return common.spread_runs(blobs, width, kind)[0]


def _summed(keys: np.ndarray, counts: np.ndarray):
    distinct, _, where = _unique(keys)
    total = np.bincount(where, weights=counts, minlength=len(distinct))
    return distinct, total.astype(np.int64), where


def _counts_for(part: pd.DataFrame) -> pd.DataFrame:
    """Training counts of the words that each shard asks for, in one bucket; with them the
    training tokens and distinct words of the bucket."""
    asked, runs = _unsorted(part["words"])
    _, total, where = _summed(asked, _unpacked(part["counts"], PART_BYTES, np.uint32))
    tokens_, distinct = int(total.sum()), int((total > 0).sum())
    bodies = common.squeeze_runs(total[where], COUNT_BYTES, runs)
    rows = [
        (shard, bucket, 0, body, b"", tokens_, distinct)
        for shard, bucket, body in zip(part["shard"], part["bucket"], bodies)
    ]
    return pd.DataFrame(rows, columns=_ANSWER)


def _trie_codes(keys: np.ndarray, bits: list[int], p: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Codes of the keys asked for, from a trie of sorted distinct keys and probabilities."""
    trie = Trie.of(split(keys, bits), bits, probability_codes(np.minimum(p, 1.0)))
    return trie.codes_of(*split(asked, bits))


def _filled(told: np.ndarray) -> np.ndarray:
    """Each 0 replaced by the last value before it; a context of 0 is in no training text, and
    what is said of it of no account."""
    return told[np.maximum.accumulate(np.where(told > 0, np.arange(len(told)), 0))]


def _codes_for(part: pd.DataFrame, step: int, mass: float, counted: bool) -> pd.DataFrame:
    """Codes of the pairs or triples that each shard asks for, from a trie of one bucket's;
    with them, if wanted, twice their training counts and one if a single shard has them."""
    asked, runs = _unsorted(part["keys"])
    keys, total, where = _summed(asked, _unpacked(part["counts"], PART_BYTES, np.uint32))
    # every shard that trains on one knows its context's count and the probability without the
    # first word; the others send 0 for the latter
    context, lower = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.uint8)
    np.maximum.at(context, where, _filled(_unpacked(part["contexts"], COUNT_BYTES, np.int64)))
    np.maximum.at(lower, where, _unpacked(part["lower"], 1, np.uint8))
    trained = total > 0
    if step == 1:
        lower = (quantised(lower[trained]) + 0.1) / part["floor"].iloc[0]
    else:
        lower = probabilities(lower[trained])
    p = (total[trained] + mass * lower) / (context[trained] + mass)
    codes = _trie_codes(keys[trained], BITS[step], p, keys)[where]
    # the lowest bit says that one shard alone has it
    counts = [b""] * len(part)
    if counted:
        told = total << 1 | (np.bincount(where, minlength=len(keys)) == 1)
        counts = common.squeeze_runs(told[where], COUNT_BYTES, runs)
    rows = [
        (shard, bucket, step, body, count, 0, 0)
        for shard, bucket, body, count in zip(
            part["shard"], part["bucket"], common.squeeze_runs(codes, 1, runs), counts
        )
    ]
    return pd.DataFrame(rows, columns=_ANSWER)


def _answers(
    part: pd.DataFrame, step: int, buckets: np.ndarray, width: int, kind, column: str = "body"
) -> np.ndarray:
    """Answers to all that a shard asked, in its own order of buckets."""
    rows = part[part["step"] == step]
    body = dict(zip(rows["bucket"], rows[column]))
    return _unpacked([body[b] for b, _, _ in by_bucket(buckets)], width, kind)


class Shard:
    """Tokens of a shard's texts, and what the answers so far tell of them."""

    def __init__(self, part: pd.DataFrame, answers: pd.DataFrame, buckets: int, mass: float, split: int):
        self.part, self.answers, self.buckets = part, answers, buckets
        self.mass, self.split = mass, split
        self.words, self.counts = tokens(common.unpressed(part["text"]))
        self.starts = np.cumsum(self.counts) - self.counts
        self.trains = np.repeat(part["trains"].to_numpy(bool), self.counts)
        asked, bucket, place = _in_buckets(self.words, buckets)
        found = _answers(answers, 0, bucket, COUNT_BYTES, np.int64)
        self.count = found[place]
        # a context is the token before it; as many texts start as end
        self.context = np.empty_like(self.count)
        self.context[1:] = self.count[:-1]
        self.context[self.starts] = self.count[self.starts + self.counts - 1]
        words = answers[answers["step"] == 0]
        self.total = int(words["tokens"].sum())
        self.floor = self.total + 0.1 * (int(words["distinct"].sum()) + 1)
        self.alone = (self.count + 0.1) / self.floor
        self.pairs = Pairs(self.words, self.starts, self.context, buckets, split)
        self.seen = self._seen(self.pairs.place, len(self.pairs.key), self.trains)

    def _seen(self, place: np.ndarray, n: int, trains: np.ndarray) -> np.ndarray:
        return np.bincount(place, weights=trains, minlength=n).astype(np.uint32)

    def _rows(self, bucket, key, seen, context, lower) -> pd.DataFrame:
        # the context's count where it changes
        new = np.diff(context, prepend=-1) != 0
        new |= np.diff(bucket, prepend=-1) != 0
        told = np.where(new, context, 0)
        lower = np.where(seen > 0, lower, 0).astype(np.uint8)
        shard = self.part["shard"].iloc[0]
        found = by_bucket(bucket)
        runs = [(i, j) for _, i, j in found]
        sent = zip(
            [b for b, _, _ in found],
            _sorted(key, runs),
            common.squeeze_runs(seen, PART_BYTES, runs),
            common.squeeze_runs(told, COUNT_BYTES, runs),
            common.squeeze_runs(lower, 1, runs),
        )
        return pd.DataFrame([(shard, *row, self.floor) for row in sent], columns=_ASKED)

    def ask_pairs(self) -> pd.DataFrame:
        p, at = self.pairs, self.pairs.first
        return self._rows(p.bucket, p.key, self.seen, self.context[at], quantise(self.count[at]))

    def after_one(self) -> np.ndarray:
        """Probability of each token after the one before it."""
        kept = probabilities(_answers(self.answers, 1, self.pairs.bucket, 1, np.uint8))
        backed = self.mass * self.alone / (self.context + self.mass)
        return np.maximum(kept[self.pairs.place], backed)

    def _triples(self, after: np.ndarray):
        """Tokens with two before them in their text; if their triple is not to be sent; the count
        of its first pair, and the code of the token after the last one."""
        place = self.pairs.place
        told = _answers(self.answers, 1, self.pairs.bucket, COUNT_BYTES, np.int64, "count")
        total, alone = told >> 1, (told & 1) > 0
        at = np.ones(len(place), dtype=bool)
        at[self.starts] = False
        at = np.flatnonzero(at)
        before, last = place[at - 1], place[at]
        # no other shard has a triple if none has one of its pairs, and none trains on it if none
        # trains on one of them
        here = alone | (total == 0)
        own = here[before] | here[last]
        return at, own, total[before], probability_codes(np.minimum(after[at], 1.0))

    def _keys(self, at: np.ndarray) -> np.ndarray:
        """Keys of the triples that end at some tokens."""
        # a token's pair is the context of the next token's triple; by its last word first
        context = self.pairs.hash[at - 1]
        middle = common.mix(self.words[at - 1])
        key = (middle & _HALF) << np.uint64(40) | (context >> np.uint64(48)) << np.uint64(24)
        return key | common.mix(context + self.words[at]) >> np.uint64(40)

    def _asked(self, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct triples that end at some tokens, whose contexts occur so often, by bucket."""
        middle = common.mix(self.words[at - 1])
        part = _part(self.pairs.hash[at - 1], self.count[at - 1], self.split)
        within = _part(self.words[at], count, self.split)
        bucket = _spread(common.mix(middle + part), within, self.buckets)
        return _distinct(bucket, self._keys(at), sum(BITS[2]))

    def ask_triples(self) -> pd.DataFrame:
        at, own, context, lower = self._triples(self.after_one())
        at, context, lower = at[~own], context[~own], lower[~own]
        bucket, key, group, first = self._asked(at, context)
        seen = self._seen(group, len(key), self.trains[at])
        return self._rows(bucket, key, seen, context[first], lower[first])

    def after_two(self) -> np.ndarray:
        """Probability of each token after the two before it, or the one if it is alone."""
        after = self.after_one()
        at, own, context, lower = self._triples(after)
        codes = np.zeros(len(at), dtype=np.uint8)
        bucket, _, group, _ = self._asked(at[~own], context[~own])
        codes[~own] = _answers(self.answers, 2, bucket, 1, np.uint8)[group]
        # the triples of this shard alone are in a trie of its own
        mine = np.flatnonzero(own)
        key, first, group = _unique(self._keys(at[mine]))
        seen = self._seen(group, len(key), self.trains[at[mine]])
        known = np.flatnonzero(seen)
        first = mine[first[known]]
        p = (seen[known] + self.mass * probabilities(lower[first])) / (context[first] + self.mass)
        found = np.zeros(len(key), dtype=np.uint8)
        found[known] = _trie_codes(key[known], BITS[2], p, key[known])
        codes[mine] = found[group]
        backed = self.mass * after[at] / (context + self.mass)
        after[at] = np.maximum(probabilities(codes), backed)
        return after

    def scores(self, order: int) -> pd.DataFrame:
        after = self.after_two() if order > 2 else self.after_one()
        parts = self.count > 0, np.log10(self.alone), np.log10(after)
        sums = [np.add.reduceat(x, self.starts) for x in parts]
        return pd.DataFrame(
            {
                "doc_id": self.part["doc_id"],
                "trains": self.part["trains"],
                "n_tokens": self.counts,
                "n_known": sums[0].astype(np.int64),
                "train_tokens": self.total,
                "base_score": sums[1],
                "score": sums[2],
            }
        )


def _ask_words(part: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Distinct words of a shard with their training counts; every bucket is asked, if only for
    its sums."""
    found, counts = tokens(common.unpressed(part["text"]))
    words, bucket, place = _in_buckets(found, buckets)
    trains = np.repeat(part["trains"].to_numpy(bool), counts)
    n = np.bincount(place, weights=trains, minlength=len(words)).astype(np.uint32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    shard = part["shard"].iloc[0]
    runs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    sent = zip(_sorted(words, runs), common.squeeze_runs(n, PART_BYTES, runs))
    rows = [(shard, b, *row) for b, row in enumerate(sent)]
    return pd.DataFrame(rows, columns=["shard", "bucket", "words", "counts"])


def score_documents(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD,
    mass: float = MASS,
    order: int = 2,
    split: int = SPLIT,
) -> DataFrame:
    """(doc_id, trains, n_tokens, n_known, train_tokens, base_score, score) of every row, by a
    model of order two or three."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    doc_id = F.col(f"`{id_col}`")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.coalesce(training, F.lit(False)).alias("trains"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // shard_bytes) + 1
    # dealt once, compressed; the steps that read the shards use the same exchange
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(id_text, F.length("text")), F.lit(n)))
    rows = rows.withColumn("text", F.pandas_udf(common.pressed, "binary")("text"))
    shards = rows.repartition(n // 2 + 1, "shard").groupBy("shard")

    def by_shard(answers: DataFrame) -> DataFrame:
        # dealt once, as the shards are; a union of what is dealt alike stays where it is
        return answers.repartition(n // 2 + 1, "shard")

    def ask_words(part: pd.DataFrame) -> pd.DataFrame:
        return _ask_words(part, n)

    def ask_pairs(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return Shard(part, answers, n, mass, split).ask_pairs()

    def ask_triples(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return Shard(part, answers, n, mass, split).ask_triples()

    def pair_codes(part: pd.DataFrame) -> pd.DataFrame:
        return _codes_for(part, 1, mass, order > 2)

    def triple_codes(part: pd.DataFrame) -> pd.DataFrame:
        return _codes_for(part, 2, mass, False)

    def score(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return Shard(part, answers, n, mass, split).scores(order)

    answer = "shard long, bucket long, step int, body binary, count binary, tokens long, distinct long"
    kind = "shard long, bucket long, keys binary, counts binary, contexts binary, lower binary, floor double"
    words = "shard long, bucket long, words binary, counts binary"
    asked = shards.applyInPandas(ask_words, words)
    answers = by_shard(asked.groupBy("bucket").applyInPandas(_counts_for, answer))
    for ask, codes in [(ask_pairs, pair_codes), (ask_triples, triple_codes)][: order - 1]:
        sent = shards.cogroup(answers.groupBy("shard")).applyInPandas(ask, kind)
        answers = answers.union(by_shard(sent.groupBy("bucket").applyInPandas(codes, answer)))
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = (
        f"doc_id {id_type}, trains boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return shards.cogroup(answers.groupBy("shard")).applyInPandas(score, kind)
