"""Holdout split, row gates and rolling-origin folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import PAIR

MIN_VALID_ROWS = 7


def add_holdout(df: DataFrame, valid_days: int = 28, scope: str = "pair") -> DataFrame:
    """Flag the last `valid_days` days, counted back from the pair's or the global last date.

    The pair's last date is a grouped maximum joined back: a hot pair shrinks to one
    row per task before the shuffle, and the rows themselves are not sorted.
    """
    start = F.date_sub("_last", valid_days - 1)
    if scope == "pair":
        last = df.groupBy(*PAIR).agg(F.max("date").alias("_last"))
        return df.join(last, PAIR).withColumn("is_valid", F.col("date") >= start).drop("_last")
    if scope == "global":
        last = df.agg(F.max("date")).scalar()
        return df.withColumn("is_valid", F.col("date") >= F.date_sub(last, valid_days - 1))
    raise ValueError(f"unknown scope {scope!r}")


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("is_valid")).alias("n_valid"),
        F.count_if(~F.col("is_valid")).alias("n_train"),
    )


def basic_gate() -> Column:
    return F.col("n_valid") >= MIN_VALID_ROWS


def forest_gate(valid_days: int = 28) -> Column:
    """Stricter gate: half of the (shorter of) holdout or series, 20 train, 7 valid rows."""
    half = F.floor(F.least(F.lit(valid_days), F.col("n_rows")) / 2)
    wanted = F.greatest(F.lit(MIN_VALID_ROWS), F.when(half == 0, F.lit(1)).otherwise(half))
    return (
        (F.col("n_valid") >= wanted)
        & (F.col("n_train") >= 20)
        & (F.col("n_valid") >= MIN_VALID_ROWS)
    )


def gated_pairs(split: DataFrame, gate: Column | None = None) -> DataFrame:
    return split_counts(split).filter(basic_gate() if gate is None else gate).select(*PAIR)


def fold_windows(
    df: DataFrame, folds: int, valid_days: int = 28, step_days: int = 28
) -> DataFrame:
    """`folds` windows per pair, the last one ending at the pair's last date."""
    last = df.groupBy(*PAIR).agg(F.max("date").alias("last"), F.count(F.lit(1)).alias("n_rows"))
    back = (F.lit(folds - 1) - F.col("fold")) * step_days
    return (
        last.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        .withColumn("fold_end", F.date_sub("last", back))
        .withColumn("fold_start", F.date_sub("fold_end", valid_days - 1))
        .select(*PAIR, "fold", "fold_start", "fold_end", "n_rows")
    )


def with_last(df: DataFrame) -> DataFrame:
    """Rows with the last date `last` and the row count `n_rows` of their pair."""
    last = df.groupBy(*PAIR).agg(F.max("date").alias("last"), F.count(F.lit(1)).alias("n_rows"))
    return df.join(last, PAIR)


def fold_columns(
    fold: int, folds: int, valid_days: int = 28, step_days: int = 28
) -> tuple[Column, Column]:
    """(row is inside the fold, row is before it), from `date` and `last`."""
    end = F.date_sub("last", (folds - 1 - fold) * step_days)
    start = F.date_sub(end, valid_days - 1)
    return F.col("date").between(start, end), F.col("date") < start


def fold_training(inside: Column, before: Column, mode: str) -> Column:
    """"outside" trains on every row outside the fold, later dates included; "past_only" on
    rows before it."""
    if mode not in ("outside", "past_only"):
        raise ValueError(f"unknown mode {mode!r}")
    return ~inside if mode == "outside" else before


def inside_folds(
    df: DataFrame, folds: int, valid_days: int = 28, step_days: int = 28
) -> DataFrame:
    """Rows with the number `fold` of each fold that holds them; other rows go."""
    own = [
        F.when(fold_columns(k, folds, valid_days, step_days)[0], F.lit(k)) for k in range(folds)
    ]
    return df.withColumn("fold", F.explode(F.array_compact(F.array(*own))))


def expand_folds(
    df: DataFrame, windows: DataFrame, mode: str = "outside", drop_unused: bool = True
) -> DataFrame:
    """Rows repeated per fold with their role: `in_fold` and `in_train`.

    "outside" trains on every row outside the fold, later dates included;
    "past_only" trains on rows before the fold. The repetition is a factor of the
    small number of folds and is followed by partial aggregates.
    """
    joined = df.join(windows, PAIR)
    inside = F.col("date").between(F.col("fold_start"), F.col("fold_end"))
    if mode == "outside":
        train = ~inside
    elif mode == "past_only":
        train = F.col("date") < F.col("fold_start")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    out = joined.withColumns({"in_fold": inside, "in_train": train})
    return out.filter(F.col("in_fold") | F.col("in_train")) if drop_unused else out


def fold_gate() -> Column:
    """Enough rows in the fold: 7, or 5 % of the pair."""
    return F.col("n_fold") >= F.greatest(
        F.lit(MIN_VALID_ROWS), F.floor(F.lit(0.05) * F.col("n_rows"))
    )
