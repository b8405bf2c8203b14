"""Lags, rolling statistics, tails, sequences and scaling per pair.

Two layouts compute the same numbers:

* `pair`: one window partition per pair. A daily panel has one row per pair and
  day, so a partition is bounded by the calendar. Callers with several rows a day,
  whose pairs may be of any length, ask for blocks.
* blocks: rows get their position first (counts per pair and period, then a
  running offset), are cut into blocks of `block_rows`, and each block also
  receives the last rows of the block before it. No task ever holds more than a
  block, so a pair of any length is spread over many tasks. The carry-over
  boundary, where frames run across pairs, is the same layout with positions
  counted over the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.schemas import PAIR
from shelfcast.session import materialize

PERIOD_DAYS = 64
BLOCK_ROWS = 100_000


@dataclass(frozen=True)
class Rolling:
    """Lags and rolling windows wanted for one column."""

    column: str
    lags: tuple[int, ...] = ()
    windows: tuple[int, ...] = ()


@dataclass(frozen=True)
class Layout:
    """`boundary` is "pair" or "carry"; `block_rows` forces blocks for "pair" too."""

    boundary: str = "pair"
    block_rows: int | None = None
    keys: tuple[str, ...] = field(default=tuple(PAIR))
    order: str = "date"


def row_order(df: DataFrame, order: str = "date") -> list[str]:
    """Columns that order the rows of a pair: the date, then the id where there is one, so
    rows of one day have the same order in every run."""
    return [order, "id"] if "id" in df.columns else [order]


def rolled_columns(spec: Rolling) -> list[str]:
    """Names of the columns that a spec adds."""
    lags = [f"{spec.column}_lag_{k}" for k in spec.lags]
    rolls = [f"{spec.column}_roll{s}_{n}" for n in spec.windows for s in ("mean", "std")]
    return lags + rolls


def add_rolling(
    df: DataFrame, specs: list[Rolling], layout: Layout | None = None
) -> DataFrame:
    """Add `<col>_lag_k`, `<col>_rollmean_w`, `<col>_rollstd_w`.

    Lags are positional. Rolling frames hold the `w` rows before the current one;
    NULLs are skipped and a standard deviation of one value is NULL.
    """
    layout = layout or Layout()
    if layout.boundary not in ("pair", "carry"):
        raise ValueError(f"unknown boundary {layout.boundary!r}")
    if layout.boundary == "pair" and layout.block_rows is None:
        return _by_pair(df, specs, layout)
    return _by_block(df, specs, layout)


def _by_pair(df: DataFrame, specs: list[Rolling], layout: Layout) -> DataFrame:
    # a single window spec: one exchange and one sort for all columns
    w = Window.partitionBy(*layout.keys).orderBy(*row_order(df, layout.order))
    new: dict[str, Column] = {}
    for s in specs:
        for k in s.lags:
            new[f"{s.column}_lag_{k}"] = F.lag(s.column, k).over(w)
        for n in s.windows:
            frame = w.rowsBetween(-n, -1)
            new[f"{s.column}_rollmean_{n}"] = F.avg(s.column).over(frame)
            new[f"{s.column}_rollstd_{n}"] = F.stddev_samp(s.column).over(frame)
    return df.withColumns(new)


def add_positions(df: DataFrame, layout: Layout) -> DataFrame:
    """Add `_pos` (position in pair, or in the whole table for "carry") and `_ppos`."""
    return _table_positions(df, layout) if layout.boundary == "carry" else _pair_positions(df, layout)


def _pair_positions(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows are counted per pair and period; only those counts are ordered, so no sort over
    a whole pair takes place."""
    keys = list(layout.keys)
    period = F.floor(F.datediff(F.col(layout.order), F.lit("1970-01-01")) / PERIOD_DAYS)
    marked = df.withColumn("_period", period)
    counts = marked.groupBy(*keys, "_period").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_in_pair", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(*keys, "_period").orderBy(*row_order(df, layout.order)))
    return (
        marked.withColumn("_rank", rank)
        .join(offsets.select(*keys, "_period", "_in_pair"), [*keys, "_period"])
        .withColumn("_ppos", F.col("_in_pair") + F.col("_rank") - 1)
        .withColumn("_pos", F.col("_ppos"))
        .drop("_period", "_rank", "_in_pair")
    )


def _table_positions(df: DataFrame, layout: Layout) -> DataFrame:
    """A prefix scan on two levels: rows are range-partitioned in the order of the table and
    written with their number inside the partition; the row counts of the partitions, one row
    each, give the offsets. A position in the pair counts from the pair's first one."""
    keys = list(layout.keys)
    order = [*keys, *row_order(df, layout.order)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Spark's increasing ids hold the partition above the number of the row
    ranged = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "table-order")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    parts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    placed = ranged.join(parts.select("_part", offset.alias("_offset")), "_part")
    placed = placed.withColumn("_pos", F.col("_at") + F.col("_offset")).drop("_at", "_part", "_offset")
    first = placed.groupBy(*keys).agg(F.min("_pos").alias("_start"))
    return placed.join(first, keys).withColumn("_ppos", F.col("_pos") - F.col("_start")).drop("_start")


def _by_block(df: DataFrame, specs: list[Rolling], layout: Layout) -> DataFrame:
    halo = max([1, *[k for s in specs for k in s.lags], *[n for s in specs for n in s.windows]])
    rows = max(layout.block_rows or BLOCK_ROWS, halo)
    own = F.floor(F.col("_pos") / rows)
    tail = F.pmod(F.col("_pos"), F.lit(rows)) >= rows - halo
    placed = (
        add_positions(df, layout)
        .withColumn("_own", own)
        .withColumn(
            "_block",
            F.explode(
                F.when(tail, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
            ),
        )
    )
    group = ["_block"] if layout.boundary == "carry" else [*layout.keys, "_block"]
    w = Window.partitionBy(*group).orderBy("_pos")
    # a value is shifted inside its pair; the empty first slot of a pair stays in the frame
    shifted = {
        f"_prev_{s.column}": F.when(F.col("_ppos") >= 1, F.lag(s.column, 1).over(w))
        for s in specs
        if s.windows
    }
    new: dict[str, Column] = {}
    for s in specs:
        for k in s.lags:
            new[f"{s.column}_lag_{k}"] = F.when(
                F.col("_ppos") >= k, F.lag(s.column, k).over(w)
            )
        for n in s.windows:
            frame = w.rowsBetween(-(n - 1), 0)
            new[f"{s.column}_rollmean_{n}"] = F.avg(f"_prev_{s.column}").over(frame)
            new[f"{s.column}_rollstd_{n}"] = F.stddev_samp(f"_prev_{s.column}").over(frame)
    return (
        placed.withColumns(shifted)
        .withColumns(new)
        .filter(F.col("_block") == F.col("_own"))
        .drop("_own", "_block", "_pos", "_ppos", *shifted)
    )


def last_rows(df: DataFrame, n: int, keys: list[str] = PAIR, order: str = "date") -> DataFrame:
    """Last `n` rows per pair. The rank filter is applied before the shuffle as well,
    so every task sends at most `n` rows of a pair."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in row_order(df, order)])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest_snapshot(df: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    return last_rows(df, 1, keys)


def pair_bounds(df: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """First and last date of the pair on every row: grouped bounds joined back, so the rows
    of a pair are neither gathered nor sorted."""
    bounds = df.groupBy(*keys).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return df.join(bounds, list(keys))


def add_sequences(
    df: DataFrame, features: list[str], window: int, name: str = "sequence"
) -> DataFrame:
    """Previous `window` rows of `features` per row, oldest first; shorter ones go."""
    w = Window.partitionBy(*PAIR).orderBy(*row_order(df)).rowsBetween(-window, -1)
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return (
        df.withColumn("_vec", vector)
        .withColumn(name, F.collect_list("_vec").over(w))
        .filter(F.size(name) == window)
        .drop("_vec")
    )


def scale_on_train(
    df: DataFrame, columns: list[str], is_train: Column, suffix: str = "_scaled"
) -> DataFrame:
    """Standard scaling per pair, fitted on training rows; zero spread divides by 1."""
    stats = df.groupBy(*PAIR).agg(
        *[F.avg(F.when(is_train, F.col(c))).alias(f"_mu_{c}") for c in columns],
        *[F.stddev_pop(F.when(is_train, F.col(c))).alias(f"_sd_{c}") for c in columns],
    )
    scaled = {
        f"{c}{suffix}": (F.col(c) - F.col(f"_mu_{c}"))
        / F.when(F.col(f"_sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{c}"))
        for c in columns
    }
    helpers = [f"_{k}_{c}" for k in ("mu", "sd") for c in columns]
    return df.join(stats, PAIR).withColumns(scaled).drop(*helpers)
