"""Operator 1: nearest neighbours along shifted Hilbert curves.

Equal vectors are one class. Each of CURVES projections maps the unit vectors to a shifted
box of few dimensions, and a Hilbert curve through it orders the classes. Every ordering is
range-partitioned by Spark; places come from the counts of the partitions. A class that is
searched for meets all classes within a window of places, and those are ranked by the exact
cosine in double precision; the best of all curves are merged.

A window spans as many blocks of BLOCK places as it needs, and those that search in a block
are dealt into chunks of about CHUNK, so a task's matrices have the same size however many
vectors there are.

The half-width of the window is a share of the classes, WINDOW. On nearly isotropic vectors
no ordering keeps neighbours together, so recall depends on the share looked at; with the
defaults it is above 0.9 on such vectors and higher on clustered ones.

Vectors that are NULL, zero, of another size than most, or hold NULL or non-finite numbers
take no part, nor do rows without id. Candidates with the id of the query are its own row.
Equal scores go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.storage import stored

CURVES = 24
WINDOW = 0.02
LEAST_WINDOW = 100
# classes of a block, and classes searched for in it together
BLOCK = 2_000
CHUNK = 500
DIMENSIONS, BITS = 8, 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (one row of integers below 2^bits) along a Hilbert curve.

    The cube is halved in all dimensions at once, from coarse to fine: the corner that holds
    the cell gives the next digit in Gray-code order, and the cell is then seen from the
    sub-cube's own orientation, by exchanging and reflecting coordinates.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for axis in range(n):
            upper = (x[axis] >> level & 1).astype(bool)
            moved = np.where(upper, 0, (x[0] ^ x[axis]) & lower)
            x[0] ^= np.where(upper, lower, moved)
            x[axis] ^= moved
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flips = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flips
    key = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = key << 1 | (x[axis] >> level & 1)
    return key


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Keys of unit vectors along one projected and shifted curve."""
    width = vectors.shape[1]
    rng = np.random.default_rng(1000 + curve)
    count = min(DIMENSIONS, width)
    directions, _ = np.linalg.qr(rng.normal(size=(width, count)))
    shift = rng.random(count)
    # a coordinate of a random unit vector has a deviation of 1/sqrt(width)
    spots = (vectors @ directions * np.sqrt(width) + 4 + shift) / 9
    cells = np.clip(spots * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert_keys(cells.astype(np.int64), BITS)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part; single precision stays until scores are made."""
    vec = F.col(f"`{vec_col}`")
    if vectors.schema[vec_col].dataType.simpleString() != "array<float>":
        vec = vec.cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull())
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    size = rows.agg(F.mode(F.size("vec"), deterministic=True)).first()[0]
    return rows.where(F.size("vec") == F.lit(size or 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _ordered(classes: DataFrame, curves: int) -> DataFrame:
    """(curve, place, cid, ids, vec, wanted): all classes in the order of each curve."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                units = _matrix(batch["vec"])
                units /= np.linalg.norm(units, axis=1)[:, None]
                for curve in range(curves):
                    yield batch.assign(curve=curve, key=curve_keys(units, curve))

    kind = classes.schema["vec"].dataType.simpleString()
    columns = f"cid long, ids array<long>, vec {kind}, wanted boolean"
    keyed = classes.mapInPandas(keys, columns + ", curve int, key long")
    parts = keyed.repartitionByRange("curve", "key", "cid").sortWithinPartitions("curve", "key", "cid")
    # written once: the places must not change when a lost part is made again
    parts = stored(parts.withColumn("part", F.spark_partition_id()), "curves")
    within = Window.partitionBy("part", "curve").orderBy("key", "cid")
    counts = parts.groupBy("part", "curve").count()
    ahead = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition and curve
    counts = counts.withColumn("before", F.coalesce(F.sum("count").over(ahead), F.lit(0)))
    placed = parts.withColumn("at", F.row_number().over(within) - 1)
    placed = placed.join(counts.drop("count"), ["part", "curve"])
    return placed.select(
        "curve", (F.col("before") + F.col("at")).alias("place"), "cid", "ids", "vec", "wanted"
    )


def best_in_block(
    block: pd.DataFrame, searched: pd.DataFrame, window: int, k: int
) -> pd.DataFrame:
    """The k best ids within the window for each class searched for, with their scores."""
    rows, columns = [], ["cid", "id", "score"]
    if not len(block) or not len(searched):
        return pd.DataFrame(rows, columns=columns)
    data, asked = _matrix(block["vec"]), _matrix(searched["vec"])
    lengths = np.linalg.norm(data, axis=1), np.linalg.norm(asked, axis=1)
    scores = asked @ data.T / lengths[1][:, None] / lengths[0][None, :]
    far = np.abs(searched["place"].to_numpy()[:, None] - block["place"].to_numpy()[None, :])
    scores[far > window] = -np.inf
    ids = block["ids"].to_numpy()
    keep = min(k, scores.shape[1])
    bound = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
    for cid, score, least in zip(searched["cid"].to_numpy(), scores, bound):
        good = np.flatnonzero((score >= least) & (score > -np.inf))
        found = sorted((-score[g], i) for g in good for i in ids[g])[:k]
        rows += [(cid, i, -s) for s, i in found]
    return pd.DataFrame(rows, columns=columns)


def _dealt(
    placed: DataFrame, half: int, block: int, chunk: int
) -> tuple[DataFrame, DataFrame]:
    """Classes (curve, block, chunk, place, ...) and those searched for in each block.

    The latter are dealt into chunks by the hash of their number; a block is sent once for
    each of its chunks, and not at all without any.
    """
    at = F.floor(F.col("place") / block)
    first, last = (F.floor((F.col("place") + step) / block) for step in (-half, half))
    asked = placed.where("wanted").select(
        F.col("curve").alias("on_curve"),
        F.explode(F.sequence(first, last)).alias("in_block"),
        F.col("place").alias("place"),
        F.col("cid").alias("cid"),
        F.col("vec").alias("vec"),
    )
    counts = asked.groupBy("on_curve", "in_block").count()
    chunks = F.ceil(F.col("count") / chunk).alias("chunks")
    counts = stored(counts.select("on_curve", "in_block", chunks), "block-chunks")
    mine = F.pmod(F.xxhash64("cid"), F.col("chunks"))
    asked = asked.join(counts, ["on_curve", "in_block"])
    asked = asked.withColumn("in_chunk", mine).drop("chunks")
    counts = counts.toDF("curve", "block", "chunks")
    data = placed.withColumn("block", at).join(counts, ["curve", "block"])
    data = data.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return data.drop("chunks", "wanted", "cid"), asked


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    curves: int = CURVES,
    window: float = WINDOW,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query.

    `is_query` is a condition on the column `id`.
    """
    rows = usable(vectors, id_col, vec_col)
    # of equal vectors only the k+1 smallest ids can be among the k nearest of any query;
    # the rank is limited before the shuffle, so a frequent vector sends no more rows
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    queries = rows.where(is_query).distinct()
    wanted = queries.select("vec").distinct().withColumn("wanted", F.lit(True))
    classes = classes.join(wanted, "vec", "left").select(
        F.col("ids")[0].alias("cid"), "ids", "vec", F.coalesce("wanted", F.lit(False)).alias("wanted")
    )
    classes = stored(classes, "vector-classes")
    # an id may have several vectors: the number of a class must be its own
    number = F.xxhash64("cid", "vec")
    classes = classes.withColumn("cid", number)
    half = max(LEAST_WINDOW, int(classes.count() * window) + 1)
    data, asked = _dealt(_ordered(classes, curves), half, block, chunk)

    def search(block: pd.DataFrame, searched: pd.DataFrame) -> pd.DataFrame:
        return best_in_block(block, searched, half, k + 1)

    found = (
        data.groupBy("curve", "block", "chunk")
        .cogroup(asked.groupBy("on_curve", "in_block", "in_chunk"))
        .applyInPandas(search, "cid long, id long, score double")
    )
    best = Window.partitionBy("cid").orderBy(F.desc("score"), "id")
    # the same pair has the same score from every curve but for the order of summation
    found = found.groupBy("cid", "id").agg(F.max("score").alias("score"))
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    pairs = queries.select(F.col("id").alias("query_id"), F.col("vec").alias("v"))
    owners = classes.where("wanted").select("cid", F.col("vec").alias("v"))
    pairs = pairs.join(owners, "v").select("query_id", "cid")
    near = pairs.join(found, "cid").where(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return near.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
