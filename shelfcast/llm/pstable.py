"""Operator 11: vectors of one label with a cosine of `cosine` or more, by p-stable hashing.

Vectors that are equal in label and components are one node. Nodes are normalised; each hash
table quantises Gaussian projections of them, floor((a.x + b) / WIDTH), and nodes that agree
on all projections of a table, and in label and length, meet in a bucket. Unit vectors of that
cosine are sqrt(2 - 2 cosine) apart, which fixes how probably they agree; the number of
projections grows with the logarithm of the number of nodes, so that a bucket holds few
strangers, and the number of tables follows from MISS, the share of pairs just at the
threshold that may meet nowhere. All pairs that meet are verified by their cosine in double
precision, so no link is wrong.

A pair that meets in several tables is counted in the first of them only, which each task
sees from the keys its rows carry; so buckets send counts and spanning links per node, never
pairs. Keys of one node only send nothing. A key of more than CROWD nodes is dealt out as
pairs of chunks; exact copies are one node, whatever their number, and add to the counts.

Vectors that are NULL, empty, zero or hold NULL, NaN or infinite components, and those of a
NULL label, link with nothing. A NULL vec_id counts as the largest; a component of such rows
only has none. Rows of one vec_id are judged one by one and linked like any others. An empty
table has no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType, LongType, StructField, StructType

from shelfcast.llm import common
from shelfcast.llm.components import connected
from shelfcast.llm.simhash import smallest_linked
from shelfcast.llm.storage import stored

WIDTH = 2.0
# share of pairs just at the threshold that meet in no table
MISS = 1e-3
# strangers a vector meets in a bucket, on average, if all are orthogonal
STRANGERS = 1 / 16
CROWD = 4_000
# rows of a task's bucket, and members compared by steps rather than by products
BUCKET_ROWS = 20_000
STEPS = 24
# rows of a product
BLOCK = 1_000


def agreement(distance: float) -> float:
    """Probability that two points that far apart agree on one projection."""
    if distance <= 0:
        return 1.0
    r = WIDTH / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(n: int, cosine: float) -> tuple[int, int]:
    """Projections of a table, and tables, for n nodes."""
    far, near = agreement(math.sqrt(2)), agreement(math.sqrt(2 - 2 * cosine))
    projections = max(1, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    missed = 1 - near**projections
    return projections, max(1, math.ceil(math.log(MISS) / math.log(missed))) if missed else 1


def units(vectors: list) -> np.ndarray:
    """Vectors of one length, each divided by its norm."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def table_keys(rows: np.ndarray, projections: int, tables: int) -> np.ndarray:
    """One 64-bit key per row and table."""
    rng = np.random.default_rng([11, rows.shape[1], projections, tables])
    axes = rng.standard_normal((rows.shape[1], projections * tables))
    shift = rng.uniform(0, WIDTH, projections * tables)
    cells = np.floor((rows @ axes + shift) / WIDTH).astype(np.int64).view(np.uint64)
    keys = np.broadcast_to(np.arange(tables, dtype=np.uint64), (len(rows), tables))
    for part in range(projections):
        keys = common.mix(keys * np.uint64(31) + cells[:, part * tables : (part + 1) * tables])
    return keys.view(np.int64)


def keyed(nodes: DataFrame, projections: int, tables: int) -> DataFrame:
    """The nodes (node, place, vector, copies) with the keys of all tables."""
    columns = ["node", "place", "vector", "copies"]
    schema = StructType([*nodes.select(*columns).schema, StructField("keys", ArrayType(LongType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = np.empty((len(batch), tables), dtype=np.int64)
            for _, part in batch.groupby(batch["vector"].str.len()).indices.items():
                rows = units(list(batch["vector"].iloc[part]))
                keys[part] = table_keys(rows, projections, tables)
            # the label and the length belong to the key
            keys ^= batch["place"].to_numpy(dtype=np.int64)[:, None]
            yield batch[columns].assign(keys=list(keys))

    return nodes.mapInPandas(run, schema)


def first_meeting(keys: np.ndarray, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of the pairs a-b of rows agree in no table before the given one."""
    return (keys[a] == keys[b]).argmax(axis=1) == table


def close_pairs(
    key: np.ndarray, side: np.ndarray, place: np.ndarray, rows: np.ndarray, cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one key and place with that cosine, sorted by key; pairs of one
    non-zero side are left out."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    small = np.repeat(sizes <= STEPS, sizes)
    at = np.flatnonzero(small)
    for step in range(1, STEPS):
        at = at[at + step < len(key)]
        at = at[key[at + step] == key[at]]
        if not len(at):
            break
        a, b = at, at + step
        met = (place[a] == place[b]) & ((side[a] == 0) | (side[a] != side[b]))
        a, b = a[met], b[met]
        near = (rows[a] * rows[b]).sum(axis=1) >= cosine
        yield a[near], b[near]
    for first, size in zip(starts[sizes > STEPS], sizes[sizes > STEPS]):
        for i in range(first, first + size, BLOCK):
            left = np.arange(i, min(i + BLOCK, first + size))
            for j in range(i, first + size, BLOCK):
                right = np.arange(j, min(j + BLOCK, first + size))
                # products may round otherwise than the sums that decide
                a, b = np.nonzero(rows[left] @ rows[right].T >= cosine - 1e-9)
                a, b = left[a], right[b]
                met = (a < b) & (place[a] == place[b]) & ((side[a] == 0) | (side[a] != side[b]))
                a, b = a[met], b[met]
                near = (rows[a] * rows[b]).sum(axis=1) >= cosine
                yield a[near], b[near]


def _met(rows: DataFrame, n: int, cosine: float) -> DataFrame:
    """(u, v, n): spanning links with n = 0, and with v = u the number of links of u.

    `rows` are (key, part, table, side, node, place, vector, copies, keys).
    """
    buckets = n // BUCKET_ROWS + 1

    def link(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in part.groupby(part["vector"].str.len()):
            same = same.sort_values("key", kind="stable")
            key, side, place = (same[c].to_numpy() for c in ("key", "side", "place"))
            node, copies, table = (same[c].to_numpy() for c in ("node", "copies", "table"))
            keys = np.stack(same["keys"].to_numpy())
            ids, where = np.unique(node, return_inverse=True)
            total, label = np.zeros(len(ids), dtype=np.int64), ids
            for a, b in close_pairs(key, side, place, units(list(same["vector"])), cosine):
                new = first_meeting(keys, a, b, table[a])
                a, b = a[new], b[new]
                np.add.at(total, where[a], copies[b])
                np.add.at(total, where[b], copies[a])
                if len(a):
                    label = smallest_linked_from(label, ids, where[a], where[b])
            moved = label != ids
            counted = total > 0
            out.append(pd.DataFrame({"u": ids[moved], "v": label[moved], "n": 0}))
            out.append(pd.DataFrame({"u": ids[counted], "v": ids[counted], "n": total[counted]}))
        return pd.concat(out)

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "part"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(link, "u long, v long, n long")


def smallest_linked_from(
    label: np.ndarray, ids: np.ndarray, a: np.ndarray, b: np.ndarray
) -> np.ndarray:
    """The labels after more links a-b; a label is the smallest node linked so far."""
    known = np.searchsorted(ids, label)
    old = np.arange(len(ids))
    return smallest_linked(ids, np.r_[a, old], np.r_[b, known])


def links(nodes: DataFrame, n: int, cosine: float, crowd: int = CROWD) -> DataFrame:
    """As `_met`, for nodes (node, place, vector, copies), n of them."""
    projections, tables = table_sizes(n, cosine)
    full = stored(keyed(nodes, projections, tables), "vector-keys")
    rows = full.select("node", F.posexplode("keys").alias("table", "key"))
    # keys go alone; a vector follows only where its key has company
    sizes = rows.groupBy("table", "key").count().where("count > 1")
    sizes = stored(
        sizes.select("table", "key", F.ceil(F.col("count") / crowd).alias("chunks")), "vector-buckets"
    )
    rows = rows.join(sizes, ["table", "key"])
    mine = F.pmod(F.xxhash64("node"), F.col("chunks"))
    rows = rows.withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 0).otherwise(F.when(F.col("mine") == low, 1).otherwise(2))
    rows = rows.select(
        "node", F.xxhash64("table", "key", low, high).alias("key"), "table", side.alias("side")
    )
    rows = stored(rows, "vector-meetings")
    met = rows.join(full, "node").withColumn("part", F.lit(0))
    return _met(met, rows.count(), cosine)


def usable(vector: Column | str) -> Column:
    values = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(values, lambda x: x != 0), F.lit(False))


def _is_float(kind: DataType) -> bool:
    return isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    crowd: int = CROWD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: the number of other rows linked
    directly, the smallest id reachable by links, and whether it is the row's own."""
    vector = F.col(f"`{vector_col}`")
    if not _is_float(vectors.schema[vector_col].dataType):
        vector = vector.cast("array<double>")
    label = F.col(f"`{label_col}`")
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), label.alias("label"), vector.alias("vector")
    )
    able = usable("vector") & F.col("label").isNotNull()
    # two hashes tell nodes apart
    one, two = F.xxhash64("label", "vector"), F.xxhash64(F.lit(11), "vector", "label")
    rows = rows.select("vec_id", "label", "vector", able.alias("able"), one.alias("h1"), two.alias("h2"))
    place = F.xxhash64("label", F.size("vector")).alias("place")
    nodes = rows.where("able").groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"),
        F.first(place).alias("place"),
        F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("least"),
    )
    # numbered as they are written, so that a lost task cannot number them anew
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    n = nodes.count()
    found = stored(links(nodes.select("node", "place", "vector", "copies"), n, cosine, crowd), "vector-links")
    counts = found.where("u = v").groupBy("u").agg(F.sum("n").alias("others"))
    roots = connected(found.where("u != v").select("u", "v"))
    known = nodes.select("h1", "h2", "node", "copies", "least")
    known = known.join(counts, known["node"] == counts["u"], "left").drop("u")
    known = known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = stored(known, "vector-classes")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select(
        "h1",
        "h2",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        "component_id",
    )
    linked = rows.where("able").select("vec_id", "h1", "h2").join(known, ["h1", "h2"])
    alone = rows.where("not able").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    found = linked.select("vec_id", "n_links", "component_id").union(alone)
    return found.withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))
