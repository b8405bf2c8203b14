"""Filters, pair selections, encodings and alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.vectors import coerce_feature
from shelfcast.schemas import PAIR
from shelfcast.session import materialize


def drop_null_target(df: DataFrame, target: str = "sales") -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def only_pair(df: DataFrame, store_nbr: int, family: str) -> DataFrame:
    return df.filter((F.col("store_nbr") == store_nbr) & (F.col("family") == family))


def recent(df: DataFrame, days: int | None, dates: DataFrame | None = None) -> DataFrame:
    """Rows of the last `days` days before the last date of the frame."""
    if not days or days <= 0:
        return df
    last = (df if dates is None else dates).agg(F.max("date")).scalar()
    return df.filter(F.col("date") >= F.date_sub(last, days - 1))


def members(
    df: DataFrame, stores: Sequence[int] | None = None, families: Sequence[str] | None = None
) -> DataFrame:
    """Keep listed stores and families; an empty list keeps all."""
    if stores:
        df = df.filter(F.col("store_nbr").isin(list(stores)))
    if families:
        df = df.filter(F.col("family").isin(list(families)))
    return df


def top_pairs(df: DataFrame, n: int, recent_days: int | None = None) -> DataFrame:
    """Best-selling `n` pairs of the last days; ties go to the smaller pair."""
    return (
        recent(df, recent_days)
        .groupBy(*PAIR)
        .agg(F.sum("sales").alias("sales"))
        .orderBy(F.col("sales").desc_nulls_last(), *PAIR)
        .limit(n)
    )


def worst(df: DataFrame, metric: str, n: int, best: bool = False) -> DataFrame:
    """Top `n` rows by metric (lowest first when `best`), pair as tie-break."""
    col = F.col(f"`{metric}`")
    order = col.asc_nulls_last() if best else col.desc_nulls_last()
    return df.orderBy(order, *PAIR).limit(n)


def in_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    return df.join(pairs.select(*PAIR), PAIR, "left_semi")


def not_in_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    return df.join(pairs.select(*PAIR), PAIR, "left_anti")


def edge_store_pairs(
    df: DataFrame,
    k: int = 5,
    stores: Sequence[int] | None = None,
    families: Sequence[str] | None = None,
    max_pairs: int | None = None,
) -> DataFrame:
    """Pairs of the first and last `k` stores: first stores ascending, then last ones.

    `max_pairs` is the caller's own limit on the list; none is applied by default.
    """
    pairs = df.select(*PAIR).filter(F.col("store_nbr").isNotNull()).distinct()
    numbers = pairs.select("store_nbr").distinct()
    chosen = (
        numbers.orderBy("store_nbr")
        .limit(k)
        .union(numbers.orderBy(F.col("store_nbr").desc()).limit(k))
        .distinct()
    )
    listed = members(pairs.join(chosen, "store_nbr", "left_semi"), stores, families)
    listed = listed.filter(F.col("family").isNotNull()).orderBy(*PAIR)
    return listed.limit(max_pairs) if max_pairs else listed


def ordinal_tables(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """For each column (value, code): sorted distinct non-NULL values numbered from 0.

    One pass collects the distinct values of all columns and writes them. They are
    range-partitioned and written with their number inside the range; running row counts of
    the ranges, one row per column and range, give the offsets.
    """
    columns = list(columns)

    def entry(i: int) -> Column:
        slots = [F.when(F.lit(k == i), F.col(c)).alias(f"_v{k}") for k, c in enumerate(columns)]
        return F.struct(F.lit(i).alias("_c"), *slots)

    entries = F.array(*[F.when(F.col(c).isNotNull(), entry(i)) for i, c in enumerate(columns)])
    order = ["_c", *[f"_v{i}" for i in range(len(columns))]]
    words = df.select(F.explode(F.array_compact(entries)).alias("e")).select("e.*").distinct()
    words = materialize(words, "vocabulary")
    ranges = words.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = materialize(ranges.withColumn("_at", F.monotonically_increasing_id()), "vocabulary")
    ranges = ranges.withColumn("_range", F.shiftright("_at", 33))
    sizes = ranges.groupBy("_c", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    running = Window.partitionBy("_c").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(running), F.lit(0)) - F.col("_first")
    offsets = sizes.select("_c", "_range", before.alias("_o"))
    coded = ranges.join(offsets, ["_c", "_range"]).withColumn("code", (F.col("_at") + F.col("_o")).cast("int"))
    return {
        c: coded.filter(F.col("_c") == i).select(F.col(f"_v{i}").alias("value"), "code")
        for i, c in enumerate(columns)
    }


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of one column, see `ordinal_tables`."""
    return ordinal_tables(df, [column])[column]


def encode_categories(df: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Add ordinal codes; a NULL value gets -1. Booleans become 0/1."""
    words = [c for c in columns if not isinstance(df.schema[c].dataType, T.BooleanType)]
    tables = ordinal_tables(df, words) if words else {}
    out = df
    for c in columns:
        if c not in tables:
            out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(c).cast("int"), F.lit(-1)))
            continue
        codes = tables[c].select(F.col("value").alias(c), F.col("code").alias(f"{c}{suffix}"))
        out = out.join(codes, c, "left").withColumn(
            f"{c}{suffix}", F.coalesce(f"{c}{suffix}", F.lit(-1))
        )
    return out


def align_features(df: DataFrame, required: Sequence[str], numeric: bool = False) -> DataFrame:
    """Columns in the wanted order; absent ones are 0.0, `numeric` coerces the rest."""

    def column(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0.0).alias(name)
        if numeric:
            return coerce_feature(F.col(name), df.schema[name].dataType).alias(name)
        return F.col(name)

    return df.select(*[column(c) for c in required])


def clean_nulls(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """NaN to NULL, and NULL to `fill` when given."""
    fixed = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns}
    df = df.withColumns(fixed)
    return df if fill is None else df.na.fill(fill, subset=list(columns))


def round_display(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Half-even rounding for display, in plain double arithmetic."""
    scale = float(10**digits)
    return df.withColumns({c: F.rint(F.col(f"`{c}`") * scale) / scale for c in columns})
