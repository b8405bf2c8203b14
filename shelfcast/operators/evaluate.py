"""Baselines on the holdout and error metrics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import metrics as M
from shelfcast.operators.windows import Layout, Rolling, add_rolling, row_order
from shelfcast.schemas import PAIR


def add_baselines(df: DataFrame, block_rows: int | None = None) -> DataFrame:
    """`naive_lag7` (value 7 rows back) and `naive_ma7` (mean of up to 7 prior rows).

    `block_rows` cuts long pairs into blocks, see `Layout`; otherwise one task sorts a pair.
    """
    if block_rows:
        rows = add_rolling(df, [Rolling("sales", (7,), (7,))], Layout(block_rows=block_rows))
        names = {"sales_lag_7": "naive_lag7", "sales_rollmean_7": "naive_ma7"}
        return rows.drop("sales_rollstd_7").withColumnsRenamed(names)
    w = Window.partitionBy(*PAIR).orderBy(*row_order(df))
    return df.withColumns(
        {
            "naive_lag7": F.lag("sales", 7).over(w),
            "naive_ma7": F.avg("sales").over(w.rowsBetween(-7, -1)),
        }
    )


def error_metrics(
    df: DataFrame, predictions: dict[str, str], keys: Sequence[str] = PAIR, y: str = "sales"
) -> DataFrame:
    """`<prefix>MAE` and `<prefix>MAPE_%` per group for each {prefix: prediction column}."""
    aggs = []
    for prefix, column in predictions.items():
        aggs.append(M.mae(F.col(y), F.col(column)).alias(f"{prefix}MAE"))
        aggs.append(M.mape(F.col(y), F.col(column)).alias(f"{prefix}MAPE_%"))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def add_gains(df: DataFrame) -> DataFrame:
    """Baseline minus model; NULL when either is missing."""
    return df.withColumns(
        {
            "MAE_GAIN_vs_LAG7": F.col("NAIVE_LAG7_MAE") - F.col("MAE"),
            "MAE_GAIN_vs_MA7": F.col("NAIVE_MA7_MAE") - F.col("MAE"),
        }
    )


def tail_profile(
    df: DataFrame, tail: int = 30, valid_days: int = 28, window: int = 7
) -> DataFrame:
    """Per pair `daily_mean`, the mean of the last `tail` rows, and `naive_MAPE_%`, the MAPE of
    the moving average over the last `valid_days` rows; that is NULL for pairs with fewer than
    valid_days + window + 1 rows.

    Both come from one ranked tail. The rank filter is applied before the shuffle as well, and
    the average runs over the same sorted rows, newest first.
    """
    needed = valid_days + window + 1
    back = Window.partitionBy(*PAIR).orderBy(*[F.col(c).desc() for c in row_order(df)])
    kept = df.withColumn("_back", F.row_number().over(back)).filter(F.col("_back") <= max(tail, needed))
    scored = kept.withColumn("_p", F.avg("sales").over(back.rowsBetween(1, window)))
    recent = F.when(F.col("_back") <= valid_days, F.col("sales"))
    return scored.groupBy(*PAIR).agg(
        F.coalesce(F.avg(F.when(F.col("_back") <= tail, F.col("sales"))), F.lit(0.0)).alias("daily_mean"),
        F.when(F.max("_back") >= needed, M.mape(recent, F.col("_p"))).alias("naive_MAPE_%"),
    )


def strict_ma7_mape(df: DataFrame, valid_days: int = 28, window: int = 7) -> DataFrame:
    """The `naive_MAPE_%` of `tail_profile` alone."""
    return tail_profile(df, 1, valid_days, window).drop("daily_mean")


def coverage_metrics(
    df: DataFrame, low: str, high: str, keys: Sequence[str] = PAIR, y: str = "sales"
) -> DataFrame:
    return df.groupBy(*keys).agg(
        M.coverage(F.col(y), F.col(low), F.col(high)).alias("coverage"),
        M.band_width(F.col(low), F.col(high)).alias("avg_width"),
    )


def tail_totals(df: DataFrame) -> DataFrame:
    """Rows with a known target and their total per pair; NULL keys are kept."""
    return df.groupBy(*PAIR).agg(
        F.count("sales").alias("N"), F.sum("sales").alias("SUM_Y")
    )


def add_wmape(metrics: DataFrame, totals: DataFrame) -> DataFrame:
    joined = metrics.join(totals, PAIR, "left")
    est = M.weighted_mape(F.col("MAE"), F.col("N"), F.col("SUM_Y"))
    return joined.withColumn("wMAPE_%_est", est)
