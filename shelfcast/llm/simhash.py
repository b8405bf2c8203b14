"""Operator 5: near duplicates by SimHash, with pivot distance tables.

A signature is one or more 64-bit fingerprints; equal signatures are one node. Nodes that
agree on the bits of a key meet in a bucket. There the Hamming distances to PIVOTS frozen
reference fingerprints are tabled, a pair is discarded when any of its distances differ by
more than the allowed bits, and the survivors are verified. A bucket sends one link per
member to the smallest of its own linked group, never all pairs.

One fingerprint (`links`): the keys are chosen bits such that any pair within `bits` agrees
on one of them, so no link is lost. A key with more than CROWD members is left out of the
buckets; its members meet at their midpoints instead, the values within bits/2 of them. Two
are within `bits` if and only if they share one, whatever the size of the crowd.

Several fingerprints (`similar`): a node is a set of shingles, whose repetitions do not
count. The keys are bands of bits and the pivots are of the first fingerprint, but the bits
are a filter only, with SLACK deviations to spare: the nodes they connect form coarse groups,
and in these a link is made where the Jaccard similarity of the shingle sets, counted from
the texts, is what was asked for. No link is made without that count, so none is wrong; a
pair is lost only if the filter misses it (`similar` says how often). Crowded bands, and
coarse groups of many nodes or long texts, are dealt out as pairs of chunks.

NULL and empty texts have fingerprint zero and are linked like any other. A NULL doc_id is
no representative unless its whole group has none. Equal ids stay separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import stored
from shelfcast.llm.components import connected

# shingles whose bits are counted together
CHUNK = 100_000
PIVOTS = 32
# members of a key compared with each other in one task
CROWD = 2_000
# rows of a bucket
BUCKET_ROWS = 200_000
# deviations by which the bits of a similar pair may exceed what is expected
SLACK = 4
# nodes and bytes of text of a chunk of a coarse group, and bytes of a bucket of chunks
GROUP = 500
PART_BYTES = 2_000_000
BUCKET_BYTES = 1_000_000


def shingle_hashes(blob: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of a text, in order."""
    parts = blob.translate(common.LOWER).split()
    if not parts:
        return np.zeros(0, dtype=">u8")
    plain = b" ".join(parts)
    starts = [0, *accumulate(len(w) + 1 for w in parts)]
    step = min(shingle, len(parts))
    digest = xxhash.xxh64_digest
    hashes = [digest(plain[s : e - 1], 42) for s, e in zip(starts, starts[step:])]
    return np.frombuffer(b"".join(hashes), dtype=">u8")


def shingle_set(blob: bytes, shingle: int) -> np.ndarray:
    """The sorted hashes of the different shingles of a text."""
    return np.unique(shingle_hashes(blob, shingle).astype(np.uint64))


def majority(hashes: np.ndarray, words: int) -> bytes:
    """Fingerprints of hashes, 8 bytes each: the majority of their bits.

    The first is of the hashes as they are; the others remix them.
    """
    if not len(hashes):
        return bytes(8 * words)
    total = np.zeros((words, 64), dtype=np.int64)
    for first in range(0, len(hashes), CHUNK):
        part = hashes[first : first + CHUNK].astype(">u8")
        for word in range(words):
            mixed = common.mix(part + np.uint64(word)).astype(">u8") if word else part
            bits = np.unpackbits(np.ascontiguousarray(mixed).view(np.uint8))
            total[word] += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(hashes)).tobytes()


def text_signature(blob: bytes, shingle: int, words: int) -> bytes:
    """Fingerprints of all shingles of a text."""
    return majority(shingle_hashes(blob, shingle), words)


def signature(text: Column | str, shingle: int, words: int, distinct: bool = False) -> Column:
    """The fingerprints of a text column: an array of longs, their bytes, and the node.

    With `distinct`, fingerprints and node are of the set of shingles; else the node is
    the fingerprints.
    """

    @F.pandas_udf("words array<long>, body binary, node long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            blobs = common.text_bytes(texts)
            if distinct:
                sets = [shingle_set(b, shingle) for b in blobs]
                rows = [majority(s, words) for s in sets]
                whole = [s.tobytes() for s in sets]
            else:
                rows = whole = [text_signature(b, shingle, words) for b in blobs]
            longs = [np.frombuffer(r, dtype=">i8").astype(np.int64) for r in rows]
            if words == 1 and not distinct:
                nodes = np.array([r[0] for r in longs], dtype=np.int64)
            else:
                digests = b"".join(xxhash.xxh64_digest(w, 42) for w in whole)
                nodes = np.frombuffer(digests, dtype=">i8").astype(np.int64)
            yield pd.DataFrame({"words": longs, "body": rows, "node": nodes})

    return run(text)


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def pivots() -> np.ndarray:
    return np.random.default_rng(5).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


def near_pairs(
    key: np.ndarray, side: np.ndarray, prints: np.ndarray, probe: int, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of one key whose fingerprints differ in `bits` in all at most,
    and the first of them in `probe`; pairs of one non-zero side are left out.

    Rows are sorted by key and by the distance to the first pivot; a pair is looked at only
    while that distance differs by `probe` at most.
    """
    table = np.bitwise_count(prints[:, :1] ^ pivots()[None, :]).astype(np.int16)
    order = np.lexsort((table[:, 0], key))
    key, side, prints, table = key[order], side[order], prints[order], table[order]
    first, second = [], []
    at = np.arange(len(key))
    step = 1
    while len(at := at[at + step < len(key)]):
        other = at + step
        near = (key[other] == key[at]) & (table[other, 0] - table[at, 0] <= probe)
        at, other = at[near], other[near]
        kept = (side[at] == 0) | (side[at] != side[other])
        a, b = at[kept], other[kept]
        discarded = (np.abs(table[a] - table[b]) > probe).any(axis=1)
        a, b = a[~discarded], b[~discarded]
        close = np.bitwise_count(prints[a, 0] ^ prints[b, 0]) <= probe
        a, b = a[close], b[close]
        verified = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64) <= bits
        first.append(order[a[verified]])
        second.append(order[b[verified]])
        step += 1
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(first + none), np.concatenate(second + none)


def exact_links(
    a: np.ndarray, b: np.ndarray, sets: list[np.ndarray], similarity: float
) -> np.ndarray:
    """Which of the pairs a-b, most similar first, are links of a spanning forest.

    The Jaccard similarity of each is counted, but for pairs that links already connect.
    """
    label = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    fewer, more = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    open_ = np.flatnonzero(fewer >= similarity * more)
    linked = []
    while len(open_):
        now, open_ = open_[: len(sets)], open_[len(sets) :]
        for i in now.tolist():
            x, y = a[i], b[i]
            if label[x] != label[y]:
                common_ = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if common_ >= similarity * (sizes[x] + sizes[y] - common_):
                    label[label == label[y]] = label[x]
                    linked.append(i)
        open_ = open_[label[a[open_]] != label[b[open_]]]
    return np.array(linked, dtype=np.int64)


def smallest_linked(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each node the smallest node of its group under the links a-b (positions)."""
    label = nodes.copy()
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == label).all():
            return label
        label = new


def key_bits(n: int, bits: int, least: int = 1) -> list[list[int]]:
    """Bit positions of each key: all choices of `agree` of bits+agree blocks.

    Two values within `bits` differ in as many blocks at most, so they agree on the others.
    `agree` is the smallest number whose keys have about as many values as there are nodes.
    """
    agree = least
    while 64 * agree / (bits + agree) < np.log2(max(n, 1)) + 2 and agree < 5:
        agree += 1
    blocks = np.array_split(np.arange(64), bits + agree)
    return [np.concatenate(c).tolist() for c in combinations(blocks, agree)]


def _bit_mask(positions: list[int]) -> int:
    mask = sum(1 << p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _bucketed(rows: DataFrame, n: int, probe: int, bits: int) -> DataFrame:
    """Links (u, v) among rows (key, part, side, node, print) of one key.

    `print` is a fingerprint, or the bytes of several. A bucket sends each member's link to
    the smallest member it is connected with there, not its pairs.
    """
    buckets = n // BUCKET_ROWS + 1

    def link(part: pd.DataFrame) -> pd.DataFrame:
        node, prints = part["node"].to_numpy(), part["print"].to_numpy()
        if prints.dtype == object:
            prints = np.frombuffer(b"".join(prints), dtype=np.uint64).reshape(len(node), -1)
        else:
            prints = prints.view(np.uint64)[:, None]
        key, side = part["key"].to_numpy(), part["side"].to_numpy()
        a, b = near_pairs(key, side, prints, probe, bits)
        ids, where = np.unique(node, return_inverse=True)
        root = smallest_linked(ids, where[a], where[b])
        moved = root != ids
        return pd.DataFrame({"u": ids[moved], "v": root[moved]})

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "part"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(link, "u long, v long").distinct()


def links(nodes: DataFrame, bits: int = 4, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) that connect all fingerprints `node` within `bits` of each other."""
    n = nodes.count()
    keys = key_bits(n, bits)
    masks = F.array(*[F.lit(_bit_mask(k)).cast("long") for k in keys])
    rows = nodes.select("node", F.posexplode(masks).alias("table", "mask")).select(
        "node", F.xxhash64("table", F.col("node").bitwiseAND(F.col("mask"))).alias("key")
    )
    crowded = rows.groupBy("key").count().where(F.col("count") > crowd).select("key")
    crowded = stored(crowded, "crowded-keys")
    members = rows.join(crowded, "key", "left_semi").select("node").distinct()
    calm = rows.join(crowded, "key", "left_anti")
    calm = calm.withColumns({"part": F.lit(0), "side": F.lit(0), "print": F.col("node")})
    return _bucketed(calm, n * len(keys), bits, bits).union(_midpoint_links(members, bits))


def _midpoint_links(members: DataFrame, bits: int) -> DataFrame:
    """Links through the values within bits/2 of a node; `bits` is even."""
    flips = [0]
    for k in range(1, bits // 2 + 1):
        flips += [_bit_mask(list(c)) for c in combinations(range(64), k)]
    around = members.select(
        "node", F.explode(F.lit(np.array(flips, dtype=np.int64))).alias("flip")
    ).select("node", F.col("node").bitwiseXOR(F.col("flip")).alias("middle"))
    least = around.groupBy("middle").agg(F.min("node").alias("v"))
    return around.join(least, "middle").select(F.col("node").alias("u"), "v").distinct()


def _chunk_pairs(rows: DataFrame, chunks: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (key, part, side, ...): rows of a key in `chunks` (key, chunks), dealt as pairs of them.

    Every pair of chunks is one key; within it only pairs of two sides are new, and side 0
    stands for a chunk that meets itself.
    """
    mine = F.pmod(F.xxhash64("node"), F.col("chunks"))
    dealt = rows.join(chunks, "key").withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    return dealt.select(
        F.xxhash64("key", low, high).alias("key"),
        F.lit(1).alias("part"),
        F.when(low == high, 0).otherwise(F.when(F.col("mine") == low, 1).otherwise(2)).alias("side"),
        *columns,
    )


def similar(
    nodes: DataFrame,
    texts: DataFrame,
    shingle: int,
    similarity: float,
    band_bits: int = 16,
    bands: int = 80,
    crowd: int = CROWD,
) -> DataFrame:
    """Links (u, v) that connect the nodes whose shingle sets have that Jaccard similarity.

    `nodes` are (node, text_hash, sig, body) and `texts` (text_hash, text), rows of which
    may repeat. Sets of similarity s have a cosine of 2s/(1+s), and a bit of their
    signatures differs with probability arccos(cosine)/pi. With the defaults, pairs of
    similarity 0.8 meet in a band with probability 0.997, those of 0.85 with 0.9999; a pair
    that meets in none is still found if links of the filter put both into one coarse group.
    Sets of few shingles differ in more bits than that formula says.
    """
    row = nodes.select(F.size("sig")).first()
    width = 64 * row[0] if row else 64
    differs = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    spread = SLACK * np.sqrt(differs * (1 - differs))
    probe, bits = (int(n * differs + spread * np.sqrt(n) + 1) for n in (64, width))
    rng = np.random.default_rng(7)
    # a band is some bits of two fingerprints
    chosen = []
    for band in range(bands):
        masks = [_bit_mask(rng.choice(64, band_bits // 2, replace=False).tolist()) for _ in "ab"]
        chosen.append((2 * band % (width // 64), (2 * band + 1) % (width // 64), *masks))
    keys = F.array(
        *[
            F.xxhash64(
                F.lit(i),
                F.col("sig")[a].bitwiseAND(F.lit(x).cast("long")),
                F.col("sig")[b].bitwiseAND(F.lit(y).cast("long")),
            )
            for i, (a, b, x, y) in enumerate(chosen)
        ]
    )
    rows = nodes.select("node", F.col("body").alias("print"), F.explode(keys).alias("key"))
    counts = rows.groupBy("key").count().where(F.col("count") > crowd)
    counts = stored(counts.select("key", F.ceil(F.col("count") / crowd).alias("chunks")), "crowded-keys")
    calm = rows.join(counts, "key", "left_anti").withColumns({"part": F.lit(0), "side": F.lit(0)})
    columns = ["key", "part", "side", "node", "print"]
    crowded = _chunk_pairs(rows, counts, ["node", "print"])
    rows = calm.select(*columns).union(crowded.select(*columns))
    coarse = connected(_bucketed(rows, nodes.count() * bands, probe, bits))
    return _confirmed(nodes, coarse, texts, shingle, similarity, probe, bits, crowd)


def _confirmed(
    nodes: DataFrame,
    coarse: DataFrame,
    texts: DataFrame,
    shingle: int,
    similarity: float,
    probe: int,
    bits: int,
    crowd: int,
) -> DataFrame:
    """Links (u, v) of that similarity inside the coarse groups (node, root).

    Pairs that pass the filter are counted, most similar signatures first; a task sends
    the links of a spanning forest.
    """
    members = nodes.join(coarse, "node").select(
        "node", "text_hash", F.col("body").alias("print"), F.col("root").alias("key")
    )
    members = stored(members, "coarse-groups")
    # equal texts send one row for each task that reads them
    found = texts.join(members, "text_hash").dropDuplicates(["node"])
    found = stored(found.select("key", "node", "print", "text"), "coarse-texts")
    size = F.octet_length("text")
    sums = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"))
    parts = F.ceil(F.greatest(F.col("n") / min(crowd, GROUP), F.col("size") / PART_BYTES))
    sums = stored(sums.select("key", "size", parts.alias("chunks")), "group-sizes")
    counts = sums.where("chunks > 1").select("key", "chunks")
    columns = ["key", "part", "side", "node", "print", "text"]
    calm = found.join(counts, "key", "left_anti").withColumns({"part": F.lit(0), "side": F.lit(0)})
    crowded = _chunk_pairs(found, counts, ["node", "print", "text"])
    rows = calm.select(*columns).union(crowded.select(*columns))
    total = sums.agg(F.sum(F.col("size") * F.col("chunks"))).first()[0] or 0
    buckets = total // BUCKET_BYTES + 1

    def link(part: pd.DataFrame) -> pd.DataFrame:
        links_ = []
        for _, group in part.groupby("key"):
            node, side = group["node"].to_numpy(), group["side"].to_numpy()
            prints = np.frombuffer(b"".join(group["print"]), dtype=np.uint64)
            prints = prints.reshape(len(node), -1)
            a, b = near_pairs(np.zeros(len(node), dtype=np.int64), side, prints, probe, bits)
            order = np.argsort(
                np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64), kind="stable"
            )
            a, b = a[order], b[order]
            sets = [shingle_set(t, shingle) for t in common.text_bytes(group["text"])]
            kept = exact_links(a, b, sets, similarity)
            links_.append(pd.DataFrame({"u": node[a[kept]], "v": node[b[kept]]}))
        return pd.concat(links_)

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "part"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(link, "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    similarity: float | None = None,
    words: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, node, group_node, fingerprint, component_id) of every row.

    With `similarity`, nodes are sets of shingles, filtered by signatures of `words`
    fingerprints and linked by their Jaccard similarity; else they are fingerprints, linked
    within `bits`.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    texts = docs.select(text_hash("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    made = signature("text", shingle, words, distinct=similarity is not None)
    prints = docs.select("doc_id", text_hash("text").alias("text_hash"), made.alias("s"))
    prints = prints.select(
        "doc_id",
        "text_hash",
        F.col("s.words").alias("sig"),
        F.col("s.body").alias("body"),
        F.col("s.node").alias("node"),
    )
    prints = stored(prints, "signatures")
    nodes = prints.groupBy("node").agg(
        F.min("doc_id").alias("least"),
        F.min("text_hash").alias("text_hash"),
        F.first("sig").alias("sig"),
        F.first("body").alias("body"),
    )
    nodes = stored(nodes, "nodes")
    if similarity is None:
        edges = links(nodes, bits)
    else:
        edges = similar(nodes, texts, shingle, similarity)
    roots = connected(edges)
    labelled = nodes.join(roots, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(least, "root").select(
        "node", F.col("root").alias("group_node"), "component_id"
    )
    classes = stored(classes, "classes")
    rows = prints.select("doc_id", "text_hash", "node", F.col("sig")[0].alias("fingerprint"))
    return rows.join(classes, "node").select(
        "doc_id", "text_hash", "node", "group_node", "fingerprint", "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row of smallest id of each group of near duplicates, with all of its columns.

    NULL ids come last; of equal ids the smaller text hash stays, and one of equal rows.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    # groups are told apart by their smallest node, since ids may repeat
    groups = found.groupBy("group_node").agg(F.min(F.struct(own_id.alias("i"), "text_hash")).alias("k"))
    kept = groups.select(F.col("k.i").alias("__i"), F.col("k.text_hash").alias("__h"))
    row_id = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1))
    # whole rows travel in one column, so that names of theirs cannot clash
    rows = docs.select(
        F.struct("*").alias("row"), row_id.alias("own_id"), text_hash(f"`{text_col}`").alias("hash")
    )
    rows = rows.join(kept, (F.col("own_id") == F.col("__i")) & (F.col("hash") == F.col("__h")), "left_semi")
    return rows.dropDuplicates(["own_id", "hash"]).select("row.*")
