"""Operator 3: bytes covered by long strings that an earlier document also has.

Documents are dealt into shards. A string of `length` bytes holds a seed: the first
of its smallest GRAM-byte hashes, so equal strings hold equal seeds at equal places.

1. Each shard sends its distinct seeds to buckets, with a mark of the stretch around each; a
   bucket answers which of them another document has, which stand amid many different
   stretches, and, of the shards that have the same stretch, which one is to send it.
2. Each shard sends the stretches around shared seeds, each distinct stretch once with its
   smallest document; the hash stands for a stretch that another shard sends. A bucket thus
   gets every string of its seeds. Strings of a seed that stands amid CROWD different
   stretches are dealt one by one, by their own hash, so that no bucket gathers all
   that surrounds a frequent passage.
3. A bucket cuts its stretches into parts of PART bytes, builds a suffix array of each by
   Larsson-Sadakane refinement, takes Kasai's common prefixes to group equal strings, merges
   the parts by binary search, and answers which strings a smaller document has.
4. Each shard marks the covered bytes.

All shuffled rows are packed arrays, and shards and buckets grow in number with the text.

NULL texts are empty. A NULL id counts as larger than all others; documents of one id never
remove from each other, and rows that repeat are treated alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common, suffixes

SHARD = 4_000_000
PART = 2_000_000
CROWD = 64
GRAM = 24
# bytes of the hash that tells the stretches of a seed apart
MARK_BYTES = 6
_MARK = np.uint64((1 << 8 * MARK_BYTES) - 1)
_BLOCK = 1 << 15
_PLACE = np.uint64((1 << 16) - 1)
_LAST_ID = (1 << 63) - 1
_K1, _K2 = np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC2B2AE3D27D4EB4F)
_K3 = np.uint64(0xA0761D6478BD642F)


@dataclass
class Stretches:
    """Runs of strings of a shard that hold the same seed at the same place."""

    data: np.ndarray
    offsets: np.ndarray  # where each text starts
    sizes: np.ndarray  # bytes of each text
    first: np.ndarray  # first string of each run
    count: np.ndarray  # its strings
    seed: np.ndarray  # its seed: bucket and 32 bits of the hash
    row: np.ndarray  # its text


def find_stretches(blobs: list[bytes], length: int, buckets: int) -> Stretches:
    data, offsets = common.pack(blobs)
    sizes = np.array([len(b) for b in blobs], dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return Stretches(data, offsets, sizes, none, none, none, none)
    least, place = _least_grams(data, length - GRAM + 1)
    # strings that end within their text, and the runs among them
    ends = offsets + np.maximum(sizes - length + 1, 0)
    new = np.ones(len(place), dtype=bool)
    new[1:] = place[1:] != place[:-1]
    new[offsets[offsets < len(place)]] = True
    opens = np.flatnonzero(new)
    row = np.searchsorted(offsets, opens, side="right") - 1
    count = np.minimum(np.diff(opens, append=len(place)), ends[row] - opens)
    inside = count > 0
    opens, row, count = opens[inside], row[inside], count[inside]
    spread = common.mix(least[opens])
    bucket = (spread >> np.uint64(32)) % np.uint64(buckets)
    seed = (bucket << np.uint64(32) | (spread & np.uint64(0xFFFFFFFF))).astype(np.int64)
    return Stretches(data, offsets, sizes, opens, count, seed, row)


def _least_grams(data: np.ndarray, grams: int) -> tuple[np.ndarray, np.ndarray]:
    """Least hash among the next `grams` grams of each position, and the first place of it.

    Worked off in blocks that stay in the processor's cache.
    """
    total = len(data) - GRAM - grams + 2
    least = np.empty(total, dtype=np.uint64)
    place = np.empty(total, dtype=np.int32)
    for first in range(0, total, _BLOCK):
        last = min(first + _BLOCK, total)
        words = suffixes.words_at(data[first : last + grams + GRAM - 2])
        n = last - first + grams - 1
        value = words[:n] * _K1 + words[8 : n + 8] * _K2
        value += words[GRAM - 8 : n + GRAM - 8] * _K3
        # the place in the block is in the lowest bits, so that the least value brings it along
        value = common.mix(value) & ~_PLACE | np.arange(n, dtype=np.uint64)
        span = 1
        while span < grams:
            step = min(span, grams - span)
            value = np.minimum(value[step:], value[:-step])
            span += step
        least[first:last] = value & ~_PLACE
        place[first:last] = (value & _PLACE).astype(np.int32) + np.int32(first)
    return least, place


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each count, one after another."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _by_bucket(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, last) of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return list(zip(bucket[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]))


def _ids(part: pd.DataFrame) -> np.ndarray:
    return part["id"].to_numpy(np.int64)


def _blobs(part: pd.DataFrame) -> list[bytes]:
    return common.unpressed(part["text"])


def _seed_rows(blobs: list[bytes], ids: np.ndarray, length: int, buckets: int) -> pd.DataFrame:
    found = find_stretches(blobs, length, buckets)
    seeds, where = np.unique(found.seed, return_inverse=True)
    low = np.full(len(seeds), _LAST_ID)
    high = np.full(len(seeds), -_LAST_ID)
    np.minimum.at(low, where, ids[found.row])
    np.maximum.at(high, where, ids[found.row])
    value = _values(found, length)
    mark = np.zeros(len(seeds), dtype=np.uint64)
    mark[where] = value
    several = np.zeros(len(seeds), dtype=bool)
    np.logical_or.at(several, where, mark[where] != value)
    # 0 stands for different stretches
    marks = np.where(several, np.uint64(0), np.maximum(mark & _MARK, np.uint64(1)))
    rows = [
        (
            b,
            common.pack_sorted(seeds[i:j].astype(np.uint32)),
            common.pack_planes(marks[i:j], MARK_BYTES),
            np.packbits(low[i:j] != high[i:j]).tobytes(),
        )
        for b, i, j in _by_bucket(seeds >> 32)
    ]
    return pd.DataFrame(rows, columns=["bucket", "seeds", "marks", "many"])


def _values(found: Stretches, length: int) -> np.ndarray:
    return common.span_hashes(found.data, found.first, found.first + found.count + length - 1)


def _shared_rows(part: pd.DataFrame, crowd: int) -> pd.DataFrame:
    """Of each shard's seeds in one bucket: shared, crowded, and to be sent by it."""
    own = [common.unpack_sorted(s, np.uint32) for s in part["seeds"]]
    seeds, where = np.unique(np.concatenate(own), return_inverse=True)
    mark = np.concatenate([common.unpack_planes(m, MARK_BYTES, np.uint64) for m in part["marks"]])
    # the first of the shards that have the same stretch, and all that have several
    sends = mark == 0
    marks, kind = np.unique(mark, return_inverse=True)
    same, stretch = np.unique(where * len(marks) + kind, return_inverse=True)
    first = np.full(len(same), len(mark))
    np.minimum.at(first, stretch, np.arange(len(mark)))
    sends[first] = True
    shards = np.bincount(where, minlength=len(seeds))
    many = np.concatenate([
        np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=len(s))
        for m, s in zip(part["many"], own)
    ])
    shared = (shards > 1) | (np.bincount(where, weights=many, minlength=len(seeds)) > 0)
    crowded = np.bincount(where, weights=sends, minlength=len(seeds)) >= crowd
    rows, first = [], 0
    for shard, bucket, seeds_of in zip(part["shard"], part["bucket"], own):
        at = where[first : first + len(seeds_of)]
        mine = sends[first : first + len(seeds_of)]
        flags = np.packbits(np.concatenate((shared[at], crowded[at], mine)))
        rows.append((shard, bucket, 0, flags.tobytes()))
        first += len(seeds_of)
    return pd.DataFrame(rows, columns=["shard", "bucket", "step", "flags"])


@dataclass
class Pieces:
    """Stretches of a shard to be sent: places in the data, and the distinct ones."""

    first: np.ndarray
    count: np.ndarray
    row: np.ndarray
    which: np.ndarray  # distinct piece of each
    bucket: np.ndarray  # of each distinct piece, sorted
    sample: np.ndarray  # a piece that equals it
    least: np.ndarray  # smallest id that has it
    value: np.ndarray  # its hash
    sent: np.ndarray  # whether its bytes are sent


def _pieces(
    found: Stretches, ids: np.ndarray, answers: pd.DataFrame, length: int, buckets: int
) -> Pieces:
    seeds, where = np.unique(found.seed, return_inverse=True)
    shared, crowded, sends = np.zeros((3, len(seeds)), dtype=bool)
    flags = dict(zip(answers["bucket"], answers["flags"]))
    for b, i, j in _by_bucket(seeds >> 32):
        bits = np.unpackbits(np.frombuffer(flags[b], dtype=np.uint8), count=3 * (j - i))
        shared[i:j], crowded[i:j], sends[i:j] = bits.reshape(3, -1)
    calm = (shared & ~crowded)[where]
    dense = (shared & crowded)[where]
    # strings of crowded seeds one by one
    first = np.concatenate((found.first[calm], _ranges(found.first[dense], found.count[dense])))
    single = np.ones(int(found.count[dense].sum()), dtype=np.int64)
    count = np.concatenate((found.count[calm], single))
    row = np.concatenate((found.row[calm], np.repeat(found.row[dense], found.count[dense])))
    value = common.span_hashes(found.data, first, first + count + length - 1)
    bucket = (value >> np.uint64(20)) % np.uint64(buckets)
    bucket = bucket.astype(np.int64)
    bucket[: calm.sum()] = found.seed[calm] >> 32
    # few buckets fit in two bytes, which are sorted faster
    order = np.argsort(value)
    small = bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket
    order = order[np.argsort(small[order], kind="stable")]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(bucket[order]) != 0) | (value[order][1:] != value[order][:-1])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    sample = order[new]
    least = np.full(len(sample), _LAST_ID)
    np.minimum.at(least, which, ids[row])
    sent = np.concatenate((sends[where[calm]], np.ones(len(single), dtype=bool)))
    return Pieces(
        first, count, row, which, bucket[sample], sample, least, value[sample], sent[sample]
    )


def _piece_rows(
    blobs: list[bytes], ids: np.ndarray, answers: pd.DataFrame, length: int, buckets: int
) -> pd.DataFrame:
    found = find_stretches(blobs, length, buckets)
    p = _pieces(found, ids, answers, length, buckets)
    press = zstandard.ZstdCompressor(level=3)
    rows = []
    for b, i, j in _by_bucket(p.bucket):
        sizes = p.count[p.sample[i:j]] + length - 1
        sent = p.sent[i:j]
        body = found.data[_ranges(p.first[p.sample[i:j][sent]], sizes[sent])]
        packed = common.squeeze(common.pack_planes(sizes, 4), 4), np.packbits(sent).tobytes(), press.compress(body)
        least = common.squeeze(common.pack_planes(p.least[i:j], 8), 8)
        rows.append((b, *packed, p.value[i:j][~sent].tobytes(), least))
    return pd.DataFrame(rows, columns=["bucket", "sizes", "sent", "body", "hashes", "least"])


def _grouped(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, length: int):
    """Of one part: the distinct strings, their smallest ids, and the string at each place."""
    order = suffixes.suffix_array(data)
    prefix = suffixes.common_prefixes(data, order, length)
    group = np.empty(len(data), dtype=np.int32 if len(data) < 1 << 30 else np.int64)
    group[order] = np.cumsum(prefix < length)
    strings = sizes - length + 1
    at = _ranges(np.cumsum(sizes) - sizes, strings)
    group = group[at]
    # groups are numbered in order, so that those in use need no sorting
    used = np.zeros(len(order) + 1, dtype=bool)
    used[group] = True
    number = np.cumsum(used) - 1
    which = number[group]
    one = np.empty(int(number[-1]) + 1, dtype=np.int64)
    one[which] = np.arange(len(at))
    least = np.full(len(one), _LAST_ID)
    np.minimum.at(least, which, np.repeat(ids, strings))
    table = np.lib.stride_tricks.sliding_window_view(data, length)[at[one]]
    return np.ascontiguousarray(table).view(f"S{length}")[:, 0], least, which


def _covered_rows(part: pd.DataFrame, length: int, part_bytes: int) -> pd.DataFrame:
    """Of each shard's pieces in one bucket: the strings that a smaller document has."""
    sizes = [common.unpack_planes(common.spread_out(s, 4), 4, np.int64) for s in part["sizes"]]
    ids = [common.unpack_planes(common.spread_out(s, 8), 8, np.int64) for s in part["least"]]
    ids = np.concatenate(ids)
    every = np.concatenate(sizes)
    sent = np.concatenate([
        np.unpackbits(np.frombuffer(f, dtype=np.uint8), count=len(s))
        for f, s in zip(part["sent"], sizes)
    ]).astype(bool)
    press = zstandard.ZstdDecompressor()
    data = np.frombuffer(b"".join(map(press.decompress, part["body"])), dtype=np.uint8)
    ends = np.cumsum(every[sent])
    value = np.zeros(len(every), dtype=np.uint64)
    value[sent] = common.span_hashes(data, ends - every[sent], ends)
    value[~sent] = np.frombuffer(b"".join(part["hashes"]), dtype=np.uint64)
    # equal pieces of several shards go into the suffix arrays once, with their smallest id
    _, which = np.unique(value, return_inverse=True)
    pieces = int(which.max()) + 1
    smallest = np.full(pieces, _LAST_ID)
    np.minimum.at(smallest, which, ids)
    size = np.zeros(pieces, dtype=np.int64)
    size[which] = every
    strings = size - length + 1
    starts = np.cumsum(strings) - strings
    # a hash without bytes, which equal marks of different stretches would leave, stays alone
    first = np.repeat(smallest, strings)
    one = np.full(pieces, -1)
    one[which[sent]] = np.arange(len(ends))
    known = np.flatnonzero(one >= 0)
    parts, owns = [], []
    for i, j in common.slices(size[known].tolist(), part_bytes):
        chosen = known[i:j]
        body = data[_ranges(ends[one[chosen]] - size[chosen], size[chosen])]
        texts, least, own = _grouped(body, size[chosen], smallest[chosen], length)
        parts.append((texts, least))
        owns.append(own)
    if parts:
        numbers = suffixes.merge_least(parts) if len(parts) > 1 else [parts[0][1]]
        merged = np.concatenate([n[own] for n, own in zip(numbers, owns)])
        first[_ranges(starts[known], strings[known])] = merged
    rows, at = [], 0
    for shard, bucket, own in zip(part["shard"], part["bucket"], sizes):
        mine = slice(at, at + len(own))
        mine_strings = every[mine] - length + 1
        least = first[_ranges(starts[which[mine]], mine_strings)]
        earlier = least < np.repeat(ids[mine], mine_strings)
        rows.append((shard, bucket, 1, np.packbits(earlier).tobytes()))
        at += len(own)
    return pd.DataFrame(rows, columns=["shard", "bucket", "step", "flags"])


def _covered(
    blobs: list[bytes], ids: np.ndarray, answers: pd.DataFrame, length: int, buckets: int
) -> tuple[Stretches, np.ndarray]:
    """The shard and which of its bytes are covered."""
    found = find_stretches(blobs, length, buckets)
    covered = np.zeros(len(found.data), dtype=bool)
    p = _pieces(found, ids, answers[answers["step"] == 0], length, buckets)
    if len(p.first):
        second = answers[answers["step"] == 1]
        flags = dict(zip(second["bucket"], second["flags"]))
        strings = p.count[p.sample]
        bits = np.concatenate([
            np.unpackbits(np.frombuffer(flags[b], dtype=np.uint8), count=int(strings[i:j].sum()))
            for b, i, j in _by_bucket(p.bucket)
        ]).astype(bool)
        starts = np.cumsum(strings) - strings
        hit = bits[_ranges(starts[p.which], p.count)]
        hit |= np.repeat(ids[p.row] > p.least[p.which], p.count)
        covered[_ranges(p.first, p.count)[hit]] = True
    # a byte is covered if one of the last strings that start at it or before it is
    strings = np.cumsum(covered, dtype=np.int32)
    before = np.concatenate((np.zeros(min(length, len(strings)), dtype=np.int32), strings[:-length]))
    return found, strings > before


def _result_rows(
    part: pd.DataFrame, answers: pd.DataFrame, length: int, buckets: int
) -> pd.DataFrame:
    found, covered = _covered(_blobs(part), _ids(part), answers, length, buckets)
    # the joints between texts are never covered, so no run goes beyond its text
    edges = np.flatnonzero(np.diff(covered.view(np.int8), prepend=0, append=0))
    firsts, lasts = edges[0::2], edges[1::2]
    body = memoryview(found.data[~covered].tobytes())
    removed = np.concatenate(([0], np.cumsum(lasts - firsts)))
    ends = found.offsets + found.sizes
    spans = np.searchsorted(firsts, np.stack((found.offsets, ends)))
    kept = np.stack((found.offsets, ends)) - removed[spans]
    rows = [
        (size, firsts[i:j] - start, lasts[i:j] - start, bytes(body[a:b]))
        for size, start, i, j, a, b in zip(
            found.sizes.tolist(), found.offsets.tolist(), *spans.tolist(), *kept.tolist()
        )
    ]
    out = pd.DataFrame(rows, columns=["n_bytes", "starts", "ends", "kept"])
    out.insert(0, "doc_id", part["doc_id"].to_numpy())
    return out


def remove_repeats(
    docs: DataFrame,
    length: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD,
    part_bytes: int = PART,
    crowd: int = CROWD,
) -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept): removed byte ranges and remaining bytes."""
    if length < GRAM + 1:
        raise ValueError(f"length must be over {GRAM}")
    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(_LAST_ID)).alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // shard_bytes) + 1
    # dealt once, compressed; the three steps that read the shards use the same exchange. The text spreads
    # rows of one id, or without an id, over the shards
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    rows = rows.withColumn("text", F.pandas_udf(common.pressed, "binary")("text"))
    shards = rows.repartition(n // 2 + 1, "shard").groupBy("shard")

    sent_columns = ["shard", "bucket", "sizes", "sent", "body", "hashes", "least"]

    def seeds(key, part: pd.DataFrame) -> pd.DataFrame:
        out = _seed_rows(_blobs(part), _ids(part), length, n)
        out.insert(0, "shard", key[0])
        return out

    def shared(part: pd.DataFrame) -> pd.DataFrame:
        return _shared_rows(part.sort_values("shard"), crowd)

    def pieces(key, part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame(columns=sent_columns)
        out = _piece_rows(_blobs(part), _ids(part), answers, length, n)
        out.insert(0, "shard", key[0])
        return out

    def covered(part: pd.DataFrame) -> pd.DataFrame:
        return _covered_rows(part.sort_values("shard"), length, part_bytes)

    def result(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return _result_rows(part, answers, length, n)

    answer = "shard long, bucket long, step int, flags binary"
    sent = shards.applyInPandas(seeds, "shard long, bucket long, seeds binary, marks binary, many binary")
    # answers are dealt as the shards are, so that their union stays where it is
    first = sent.groupBy("bucket").applyInPandas(shared, answer).repartition(n // 2 + 1, "shard")
    sent = shards.cogroup(first.groupBy("shard")).applyInPandas(
        pieces, "shard long, bucket long, " + ", ".join(f"{c} binary" for c in sent_columns[2:])
    )
    second = sent.groupBy("bucket").applyInPandas(covered, answer).repartition(n // 2 + 1, "shard")
    both = first.union(second).groupBy("shard")
    kind = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    return shards.cogroup(both).applyInPandas(result, kind)
