"""Operator 12: the best documents for each item, by branch and bound in document FP-trees.

Terms are alphanumeric words (bytes from 128 on count as letters), A-Z in lower case. A first
pass keeps of every document its number of terms and how often it holds the terms of the
items; grouped sums of that table give the corpus counts. Then every task orders the terms of
its documents by document frequency, most frequent first, so that documents share the paths
of a prefix tree. A node keeps, for all terms below it, the largest tf, and the smallest m of
its documents; from these comes a bound on the score of any document below, for each item. The
tree is searched depth first, an item follows a branch only while the bound reaches its own
k-th best score, and the documents of a branch that is reached at its end are scored in full.
Tasks send k rows per item; a ranked window merges them.

Scores are sums of integers; ties go to the smaller document id. Items are searched by their
text, once for all items of equal text, in blocks of BLOCK bytes; each block broadcasts its
terms and reads the documents once. A task's trees hold SHARD documents each, which need not
share a key, so no term or copied text gathers rows anywhere.

NULL and empty texts have no terms: such documents are not counted and such items get no
rows. Rows of equal ids are ranked one by one. A NULL document id counts as the largest long,
and both are NULL in the result. A NULL item id stays NULL. Terms are compared by 64-bit
hashes.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import share, stored

BEST = 10
# bytes of item texts searched for together
BLOCK = 8_000_000
# documents of a tree, and of a branch that is scored without further branching
SHARD = 20_000
LEAF = 256
# scores of a branch held at once
CELLS = 4_000_000
# bytes of text cut into words at once
PART = 4_000_000
LAST_ID = (1 << 63) - 1


def pieces(blob: bytes, limit: int) -> Iterator[bytes]:
    """Parts of a text of about that size, cut between words."""
    at = 0
    while len(blob) - at > limit:
        end = at + limit
        while end < len(blob):
            window = np.frombuffer(blob, dtype=np.uint8, count=min(4096, len(blob) - end), offset=end)
            breaks = np.flatnonzero(common.IS_BREAK[window])
            if len(breaks):
                end += int(breaks[0])
                break
            end += len(window)
        yield blob[at:end]
        at = end
    yield blob[at:]


def term_hashes(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of terms and the number of their text, part by part."""
    parts, owners = [], []
    for number, blob in enumerate(blobs):
        for piece in pieces(blob.translate(common.LOWER), PART):
            parts.append(piece)
            owners.append(number)
    for first, last in common.slices([len(p) for p in parts], PART):
        data, offsets = common.pack(parts[first:last])
        starts, ends = common.word_bounds(data, common.IS_BREAK)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        yield common.span_hashes(data, starts, ends), np.array(owners[first:last], dtype=np.int64)[owner]


def counted(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order and the sums of their counts."""
    found, where = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, where, np.concatenate([np.zeros(0, np.int64), *counts]))
    return found, total


def term_counts(blobs: list[bytes], words: np.ndarray) -> tuple[np.ndarray, list, list]:
    """For each text its number of terms, and which of the sorted words it has how often."""
    lengths = np.zeros(len(blobs), dtype=np.int64)
    codes, counts = [], []
    size = max(len(words), 1)
    for hashes, owner in term_hashes(blobs):
        lengths += np.bincount(owner, minlength=len(blobs))
        at = np.minimum(np.searchsorted(words, hashes), size - 1)
        known = words[at] == hashes if len(words) else np.zeros(len(hashes), dtype=bool)
        code, count = np.unique(owner[known] * size + at[known], return_counts=True)
        codes.append(code)
        counts.append(count)
    code, count = counted(codes, counts)
    cuts = np.searchsorted(code // size, np.arange(1, len(blobs)))
    return lengths, np.split(code % size, cuts), np.split(count, cuts)


def vocabulary(blobs: list[bytes]) -> np.ndarray:
    """The sorted hashes of the terms of texts."""
    found = [np.unique(h) for h, _ in term_hashes(blobs)]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))


@dataclass
class ItemIndex:
    """Items by term: terms are numbered by document frequency, the most frequent first."""

    number: np.ndarray  # of each word of the sorted vocabulary
    weight: np.ndarray  # by number
    first: np.ndarray  # where the items of a term start, by number
    item: np.ndarray
    times: np.ndarray
    items: int
    exact: bool  # whether doubles hold all scores

    @staticmethod
    def make(words: np.ndarray, blobs: list[bytes], frequency: np.ndarray, n: int) -> ItemIndex:
        order = np.lexsort((np.arange(len(words)), -frequency))
        number = np.empty(len(words), dtype=np.int64)
        number[order] = np.arange(len(words))
        odds = [(2 * n + 2) / (2 * df + 1) for df in frequency[order].tolist()]
        weight = np.array([math.floor(1000 * math.log(x)) for x in odds], dtype=np.int64)
        _, terms, times = term_counts(blobs, words)
        item = np.repeat(np.arange(len(blobs)), [len(t) for t in terms])
        term = number[np.concatenate([np.zeros(0, np.int64), *terms])]
        times = np.concatenate([np.zeros(0, np.int64), *times])
        by_term = np.argsort(term, kind="stable")
        term, item, times = term[by_term], item[by_term], times[by_term]
        first = np.searchsorted(term, np.arange(len(words) + 1))
        # a term adds less than 10^6 times its weight
        most = np.zeros(len(blobs))
        np.add.at(most, item, 1e6 * weight[term] * times)
        exact = bool((most < 2**53).all())
        return ItemIndex(number, weight, first, item, times, len(blobs), exact)

    def scores(
        self, row: np.ndarray, rows: int, term: np.ndarray, tf: np.ndarray, m: np.ndarray,
        active: np.ndarray,
    ) -> np.ndarray:
        """Sums of the terms' parts by row and active item; row, term, tf and m are entries."""
        part = self.weight[term] * ((10**9 * tf) // (1000 * tf + 8 * m))
        lengths = self.first[term + 1] - self.first[term]
        entry = np.repeat(np.arange(len(term)), lengths)
        at = np.arange(len(entry)) + np.repeat(self.first[term] - (np.cumsum(lengths) - lengths), lengths)
        place = np.full(self.items, -1)
        place[active] = np.arange(len(active))
        column = place[self.item[at]]
        live = column >= 0
        entry, at, column = entry[live], at[live], column[live]
        cell = row[entry] * len(active) + column
        value = part[entry] * self.times[at]
        if self.exact:
            total = np.bincount(cell, weights=value, minlength=rows * len(active)).astype(np.int64)
        else:
            total = np.zeros(rows * len(active), dtype=np.int64)
            np.add.at(total, cell, value)
        return total.reshape(rows, len(active))


def largest(term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms and the largest tf of each."""
    order = np.argsort(term, kind="stable")
    term, tf = term[order], tf[order]
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    return term[starts], np.maximum.reduceat(tf, starts) if len(starts) else tf


class Tree:
    """Documents as paths of terms in ascending number, with bounds at the nodes.

    A node is a range of documents in the order of their paths. Neighbouring branches of few
    documents share one node.
    """

    def __init__(self, paths: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray, ids: np.ndarray):
        keys = [p.astype(">u4").tobytes() for p in paths]
        order = sorted(range(len(paths)), key=keys.__getitem__)
        self.ids, self.m = ids[order], m[order]
        sizes = np.array([len(paths[i]) for i in order], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        none = [np.zeros(0, dtype=np.int64)]
        self.term = np.concatenate(none + [paths[i] for i in order])
        self.tf = np.concatenate(none + [tfs[i] for i in order])
        self.shared = self._shared(sizes)

    def _shared(self, sizes: np.ndarray) -> np.ndarray:
        """Length of the common path of each document and the next."""
        out = np.minimum(sizes[:-1], sizes[1:])
        live, depth = np.flatnonzero(out > 0), 0
        while len(live):
            same = self.term[self.start[live] + depth] == self.term[self.start[live + 1] + depth]
            out[live[~same]] = depth
            depth += 1
            live = live[same]
            live = live[out[live] > depth]
        return out

    def branches(self, low: int, high: int, leaf: int) -> list[tuple[int, int]]:
        """The ranges in which a range splits behind its common path."""
        inner = self.shared[low : high - 1]
        cuts = [low, *(np.flatnonzero(inner == inner.min()) + low + 1).tolist(), high]
        out: list[tuple[int, int]] = []
        for a, b in zip(cuts, cuts[1:]):
            if out and b - out[-1][0] <= leaf:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def grow(self, low: int, high: int, leaf: int) -> Node:
        """The node of a range, its descendants made first."""
        done: list[Node] = []
        stack: list[tuple[int, int, list[tuple[int, int]] | None]] = [(low, high, None)]
        while stack:
            a, b, parts = stack.pop()
            if b - a <= leaf:
                inside = slice(self.start[a], self.start[b])
                top = largest(self.term[inside], self.tf[inside])
                done.append(Node(a, b, *top, int(self.m[a:b].min()), []))
            elif parts is None:
                parts = self.branches(a, b, leaf)
                stack.append((a, b, parts))
                stack += [(x, y, None) for x, y in parts]
            else:
                below = [done.pop() for _ in parts]
                term = np.concatenate([n.term for n in below])
                top = largest(term, np.concatenate([n.tf for n in below]))
                done.append(Node(a, b, *top, min(n.m for n in below), below))
        return done[0]


@dataclass
class Node:
    low: int
    high: int
    term: np.ndarray
    tf: np.ndarray
    m: int
    below: list[Node]


class Search:
    """The best documents so far of each item."""

    def __init__(self, index: ItemIndex, best: int):
        self.index, self.best = index, best
        self.found = [(np.zeros(0, dtype=np.int64),) * 2] * index.items
        self.least = np.ones(index.items, dtype=np.int64)
        self.leaf = max(16, min(LEAF, CELLS // max(index.items, 1)))

    def bound(self, node: Node, active: np.ndarray) -> np.ndarray:
        row = np.zeros(len(node.term), dtype=np.int64)
        return self.index.scores(row, 1, node.term, node.tf, np.int64(node.m), active)[0]

    def visit(self, tree: Tree) -> None:
        """Depth first, the most promising branch first; items leave hopeless branches."""
        if not len(tree.ids):
            return
        root = tree.grow(0, len(tree.ids), self.leaf)
        everyone = np.arange(self.index.items)
        stack = [(root, everyone, self.bound(root, everyone))]
        while stack:
            node, active, bound = stack.pop()
            # equal scores may still win by their id
            live = bound >= self.least[active]
            active = active[live]
            if not len(active):
                continue
            if not node.below:
                self.score(tree, node, active)
                continue
            bounds = [self.bound(n, active) for n in node.below]
            for i in sorted(range(len(bounds)), key=lambda i: int(bounds[i].max())):
                stack.append((node.below[i], active, bounds[i]))

    def score(self, tree: Tree, node: Node, active: np.ndarray) -> None:
        """Scores of all documents of a node for the items that reach it."""
        low, high = node.low, node.high
        inside = slice(tree.start[low], tree.start[high])
        row = np.repeat(np.arange(high - low), np.diff(tree.start[low : high + 1]))
        m = tree.m[low:high]
        scores = self.index.scores(row, high - low, tree.term[inside], tree.tf[inside], m[row], active)
        ids = tree.ids[low:high]
        for column in np.flatnonzero((scores >= self.least[active]).any(axis=0)).tolist():
            item = active[column]
            rows = np.flatnonzero(scores[:, column] >= self.least[item])
            score = np.concatenate((self.found[item][0], scores[rows, column]))
            own = np.concatenate((self.found[item][1], ids[rows]))
            order = np.lexsort((own, -score))[: self.best]
            self.found[item] = (score[order], own[order])
            if len(order) == self.best:
                self.least[item] = score[order[-1]]


def document_vectors(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """(id, n, terms, tfs) of documents (id, text) that have a term."""
    shared = share(docs.sparkSession, words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = pickle.loads(shared.value)
        for batch in batches:
            lengths, terms, tfs = term_counts(common.text_bytes(batch["text"]), known)
            found = pd.DataFrame({"id": batch["id"], "n": lengths})
            found["terms"], found["tfs"] = terms[: len(batch)], tfs[: len(batch)]
            yield found[found["n"] > 0]

    return docs.mapInPandas(run, "id long, n long, terms array<long>, tfs array<long>")


def _searched(vectors: DataFrame, index: ItemIndex, keys: list[int], n: int, total: int, best: int) -> DataFrame:
    """(key, id, score): the best documents of every task for each item key."""
    shared = share(vectors.sparkSession, index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: ItemIndex = pickle.loads(shared.value)
        search = Search(own, best)
        for batch in batches:
            for first in range(0, len(batch), SHARD):
                part = batch.iloc[first : first + SHARD]
                paths, tfs = [], []
                for terms, tf in zip(part["terms"], part["tfs"]):
                    path = own.number[terms]
                    order = np.argsort(path)
                    paths.append(path[order])
                    tfs.append(tf[order])
                # the product may pass 64 bits on a very large corpus
                m = [25 + 75 * x * n // total for x in part["n"].tolist()]
                search.visit(Tree(paths, tfs, np.array(m, dtype=np.int64), part["id"].to_numpy()))
        sizes = [len(s) for s, _ in search.found]
        none = [np.zeros(0, dtype=np.int64)]
        yield pd.DataFrame(
            {
                "key": np.repeat(np.array(keys, dtype=np.int64), sizes),
                "id": np.concatenate(none + [i for _, i in search.found]),
                "score": np.concatenate(none + [s for s, _ in search.found]),
            }
        )

    return vectors.mapInPandas(run, "key long, id long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of each item with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    text = F.col(f"`{item_text_col}`")
    asked = items.where(text.isNotNull()).select(
        F.col(f"`{item_col}`").alias("item_id"), text.alias("text"), F.xxhash64(text).alias("key")
    )
    asked = stored(asked, "items")
    texts = asked.groupBy("key").agg(F.first("text").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block + 1
    found = None
    for number in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == number).collect()
        blobs = common.text_bytes(r["text"] for r in rows)
        words = vocabulary(blobs)
        vectors = stored(document_vectors(docs, words), "term-vectors")
        n, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = np.zeros(len(words), dtype=np.int64)
        counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
        for row in counts.toLocalIterator():
            frequency[row["term"]] = row["count"]
        index = ItemIndex.make(words, blobs, frequency, n)
        part = _searched(vectors, index, [r["key"] for r in rows], n, total, best)
        found = part if found is None else found.union(part)
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return asked.select("item_id", "key").join(ranked, "key").select(
        "item_id",
        "rank",
        F.nullif("id", F.lit(LAST_ID)).alias("doc_id"),
        "score",
    )
