"""Operator 10: repeated runs of lines, found by winnowing over line hashes.

Lines are the parts of a text between line feeds; blank ones (spaces only) are left alone.
A run qualifies from `least` characters on, so a long line counts by itself and short ones
only together; a text that is shorter than that is one run. All lines of every qualifying run
that also stands earlier are deleted. Earlier is by doc_id, then by line; NULL ids come last.

A window is the shortest qualifying run from a line on, or up to a line. The smallest line hash
of a window is its fingerprint, so any two texts that share a window share a fingerprint in
it. Positions of fingerprints that stand in two places are joined, and a match is extended to
both sides by the windows that go on from it: each line of a repeated run lies in a window
inside the run, the one from it on or, near the right end, the one up to the end. So what the
equal windows cover together are the maximal repeated runs.

NULL texts are empty; texts that lose all lines become empty. Rows equal in id and text are
one place and share their fate; of equal ids with different texts, that of the smaller text
hash comes first. Lines and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.storage import stored

LEAST = 20
_LAST_ID = (1 << 63) - 1


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def windows(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, hash, at, lines, anchor, whole): each window of documents (id, hash, text), from
    its first line `at` on."""
    line = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            i.alias("at"),
            F.xxhash64(x).alias("h"),
            F.length(x).alias("n"),
            (F.trim(x) != "").alias("full"),
        ),
    )
    found = F.filter(line, lambda x: x["full"])
    # one row for rows equal in id and text; what follows stays in its partition
    places = docs.groupBy("id", "hash").agg(F.first(found).alias("lines"))
    rows = places.select("id", "hash", F.inline("lines"))
    before = Window.partitionBy("id", "hash").orderBy("at")
    offset = F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("offset", F.coalesce(offset, F.lit(0)).cast("long"))
    rows = rows.withColumn("stop", F.col("offset") + F.col("n"))
    place = Window.partitionBy("id", "hash")
    # the lines that start less than `least` characters after this one starts, and those that
    # stop less than that before it stops
    onward = place.orderBy("offset").rangeBetween(0, least - 1)
    upto = place.orderBy("stop").rangeBetween(1 - least, 0)

    def window(run) -> Column:
        return F.struct(
            F.sum("n").over(run).alias("size"),
            F.min("h").over(run).alias("anchor"),
            F.collect_list("h").over(run).alias("run"),
            F.collect_list("at").over(run).alias("lines"),
        )

    rows = rows.select("id", "hash", "offset", window(onward).alias("a"), window(upto).alias("b"))
    kept = [
        F.when((F.col("a.size") >= least) | (F.col("offset") == 0), F.col("a")),
        F.when(F.col("b.size") >= least, F.col("b")),
    ]
    # a long line is both windows at once
    found = rows.select("id", "hash", F.inline(F.array_distinct(F.array_compact(F.array(*kept)))))
    return found.select(
        "id", "hash", F.col("lines")[0].alias("at"), "lines", "anchor", F.xxhash64("run").alias("whole")
    )


def repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, hash, removed): line numbers to delete of documents (id, hash, text)."""
    # what the joins below read is written first: both sides then arrive through exchanges of
    # their own, and adaptive execution can split a frequent line over many tasks
    found = stored(windows(docs, least), "line-windows")
    place = F.struct("id", "hash", "at")
    # fingerprints that stand in two places, by sums made before the shuffle
    shared = found.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    shared = stored(shared.where("a != b").select("anchor"), "line-fingerprints")
    candidates = found.join(shared, "anchor", "left_semi")
    first = candidates.groupBy("anchor", "whole").agg(
        F.min(place).alias("first"), F.max(place).alias("last")
    )
    first = stored(first.where("first != last").drop("last"), "line-first")
    later = candidates.join(first, ["anchor", "whole"]).where(place > F.col("first"))
    lines = later.select("id", "hash", F.explode("lines").alias("line"))
    return lines.groupBy("id", "hash").agg(F.collect_set("line").alias("removed"))


def dedup_lines(
    docs: DataFrame,
    least: int = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
    kept: str = "kept",
    removed: str = "n_removed",
) -> DataFrame:
    """The rows with two more columns: the text without the deleted lines, and their number."""
    own_id = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST_ID))
    text = _text(text_col)
    keyed = docs.select(own_id.alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    drop = repeated_lines(keyed, least).select(
        F.col("id").alias("__id"), F.col("hash").alias("__hash"), F.col("removed").alias("__removed")
    )
    # whole rows travel in one column, so that names of theirs cannot clash
    rows = docs.select(
        F.struct("*").alias("row"), own_id.alias("own_id"), F.xxhash64(text).alias("own_hash")
    )
    joined = rows.join(drop, (rows["own_id"] == drop["__id"]) & (rows["own_hash"] == drop["__hash"]), "left")
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__removed"))
    # the outer array of one holds the split lines, so they are made once and not per line
    rest = F.transform(
        F.array(lines), lambda all_: F.array_join(F.transform(stay, lambda i: all_[i]), "\n")
    )[0]
    changed = {
        kept: F.when(F.col("__removed").isNull(), text).otherwise(rest),
        removed: F.coalesce(F.size("__removed"), F.lit(0)).cast("long"),
    }
    others = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in changed]
    return joined.select(*others, *[c.alias(name) for name, c in changed.items()])
