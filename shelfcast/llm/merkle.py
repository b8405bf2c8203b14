"""Operator 13: Merkle tree over a table, one subtree per group, by sibling-shift self-joins.

A node has a place in its group. Every level joins the nodes with themselves on the computed
place of the sibling (XOR for two children, slot offsets for more), which gives each node what
stands left and right of it in its run; the nodes in slot zero then emit the parents. A run
that ends early, even of one node, becomes a parent too. The remaining nodes of the groups are
the leaves of one more tree. The way back down joins every node with its parent's path, so all
proofs together cost one row per node and not one per leaf and level.

Places come from a range sort of ids and leaf digests with row counts of its partitions, so a
group of any size is spread over tasks; rows that are equal in everything still get a place
each. Inside a group NULL ids come first, equal ids follow each other by leaf digest; a NULL
group is a group of its own and comes first. An empty table has no rows and no root. Texts
are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.storage import stored

# the row number inside a partition takes the low bits of Spark's increasing ids
ROW_BITS = 33


def encoded(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def hex_text(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def digest(*texts: Column) -> Column:
    """SHA-256 of texts put together, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*texts).cast("binary"), 256))


def row_digest(*values: Column) -> Column:
    return digest(*[encoded(v) for v in values])


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with their place `pos` inside the group, in that order, and its size `n`."""
    keys = [group, *order, "_tie"]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    # written with their numbers, so that a lost task cannot number them anew
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    ranged = ranged.withColumn("_part", F.shiftright("_at", ROW_BITS))
    blocks = ranged.groupBy(group, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(
        whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = blocks.select(
        group,
        "_part",
        "_first",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("n"),
    )
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    found = ranged.join(blocks, [group, "_part"]).withColumn("pos", pos)
    return found.drop("_at", "_part", "_first", "_before")


def _joined(parts: list[Column]) -> Column:
    none = F.lit(b"")
    return F.concat(none, *[F.coalesce(p, none) for p in parts])


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """The nodes (grp, pos, hash, ...) with the digests left and right of them in their run."""
    slot = F.pmod("pos", F.lit(fanout))
    found = nodes
    for offset in range(1, fanout):
        if fanout == 2:
            place = F.col("pos").bitwiseXOR(F.lit(1).cast("long"))
        else:
            place = F.col("pos") - slot + F.pmod(slot - offset, F.lit(fanout))
        other = nodes.select(
            F.col("grp").alias("_grp"), place.alias("_pos"), F.col("hash").alias(f"_s{offset}")
        )
        met = (found["grp"] == other["_grp"]) & (found["pos"] == other["_pos"])
        found = found.join(other, met, "left").drop("_grp", "_pos")
    after = [F.when(slot + o < fanout, F.col(f"_s{o}")) for o in range(1, fanout)]
    before = [F.when(slot + o >= fanout, F.col(f"_s{o}")) for o in range(1, fanout)]
    found = found.withColumns({"left": _joined(before), "right": _joined(after)})
    return found.drop(*[f"_s{o}" for o in range(1, fanout)])


def climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Each level with siblings, and the remaining node of each group (grp, level, hash).

    `nodes` are (grp, pos, n, hash, ...); further columns stay in the first level.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], []
    while True:
        last = nodes.where("n = 1").select("grp", F.lit(len(levels)).alias("level"), "hash")
        tops.append(last)
        if most <= 1:
            break
        level = stored(with_siblings(nodes.where("n > 1"), fanout), "merkle-level")
        levels.append(level)
        nodes = level.where(F.pmod("pos", F.lit(fanout)) == 0).select(
            "grp",
            F.floor(F.col("pos") / fanout).alias("pos"),
            F.ceil(F.col("n") / fanout).alias("n"),
            digest(hex_text("hash"), hex_text("right")).alias("hash"),
        )
        most = -(-most // fanout)
    return levels, stored(reduce(DataFrame.unionByName, tops), "merkle-tops")


def descend(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The first of one or more levels with `path`: the siblings of each node and of all above
    it, then the path of its top. `tops` are (grp, level, path)."""
    above = tops.where(F.col("level") == len(levels)).select("grp", F.lit(0).cast("long").alias("pos"), "path")
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number]
        parents = above.select(
            F.col("grp").alias("_grp"), F.col("pos").alias("_pos"), F.col("path").alias("_path")
        )
        met = (level["grp"] == parents["_grp"]) & (
            F.floor(level["pos"] / fanout) == parents["_pos"]
        )
        step = F.array(F.struct("left", "right"))
        found = level.join(parents, met).withColumn("path", F.concat(step, "_path"))
        found = found.drop("_grp", "_pos", "_path", "left", "right")
        if number == 0:
            return found
        # groups whose last node stands on this level join here
        ends = tops.where(F.col("level") == number)
        ends = ends.select("grp", F.lit(0).cast("long").alias("pos"), "path")
        above = stored(found.select("grp", "pos", "path").unionByName(ends), "merkle-path")
    raise ValueError("no level")


def manifest(
    rows: DataFrame, group: Column, row_id: Column, leaf: Column, fanout: int = 2, **extra: Column
) -> DataFrame:
    """(id, leaf, subroot, root, path, and `extra`) of each row; digests are 32 bytes.

    `path` holds, level by level, the digests left and right of the row's way to the root.
    """
    leaves = rows.select(
        row_id.alias("id"),
        encoded(group).alias("grp"),
        group.alias("name"),
        leaf.alias("hash"),
        F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in extra.items()]).alias("extra"),
    )
    leaves = stored(leaves, "merkle-leaves")
    nodes = stored(numbered(leaves, "grp", ["id", "hash"]), "merkle-nodes")
    levels, tops = climb(nodes.drop("name"), fanout)
    names = leaves.select("grp", "name").distinct()
    tops = tops.join(names, "grp").select(
        F.lit("").alias("all"), "name", "hash", F.col("grp").alias("sub"), F.col("level").alias("sub_level")
    )
    tops = stored(tops, "merkle-subroots")
    subroots = numbered(tops, "all", ["name"]).withColumnRenamed("all", "grp")
    upper, end = climb(subroots, fanout)
    last = end.first()
    root = F.lit(last["hash"] if last else None).cast("binary")
    step = F.struct(F.lit(b"").alias("left"), F.lit(b"").alias("right"))
    empty = F.filter(F.array(step), lambda s: F.lit(False))
    if upper:
        over = descend(upper, end.withColumn("path", empty), fanout)
    else:
        over = subroots.withColumn("path", empty)
    over = over.select(
        F.col("sub").alias("grp"), F.col("sub_level").alias("level"), F.col("hash").alias("subroot"), "path"
    )
    over = stored(over, "merkle-subroot-paths")
    # a leaf alone in its group is the subroot
    lone = nodes.where("n = 1").join(over.select("grp", "path"), "grp")
    columns = ["id", "grp", "hash", "extra", "path"]
    found = lone.select(*columns)
    if levels:
        found = descend(levels, over.drop("subroot"), fanout).select(*columns).unionByName(found)
    found = found.join(over.select("grp", "subroot"), "grp")
    return found.select(
        "id",
        F.col("hash").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        *[F.col(f"extra.{k}").alias(k) for k in extra],
    )


def proof_text(path: Column | str) -> Column:
    """The siblings of a path as hex texts put together, left to right."""
    sides = F.transform(path, lambda s: F.concat(hex_text(s["left"]), hex_text(s["right"])))
    return F.array_join(sides, "")


def fold(leaf: Column | str, path: Column | str) -> Column:
    """The root that a leaf leads to along a path."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(
        path,
        start,
        lambda at, s: digest(hex_text(s["left"]), hex_text(at), hex_text(s["right"])),
    )
