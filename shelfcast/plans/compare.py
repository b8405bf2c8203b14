"""Comparing models: pairwise on tails, backtests, and across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import metrics as M
from shelfcast.operators.evaluate import error_metrics
from shelfcast.operators.resample import resample
from shelfcast.schemas import PAIR


def compare_on_tail(
    pairs: DataFrame,
    fitted: DataFrame,
    tail: DataFrame,
    a: str,
    b: str,
    min_tail_sales: float = 0.0,
    names: tuple[str, str] = ("A", "B"),
) -> DataFrame:
    """MAE and MAPE of two prediction columns for every pair, gains of b over a, and the
    reason why a pair is left out (NULL when it is compared).

    `pairs` are all pairs, `fitted` those that have the first model. Reasons are looked for
    in this order: no model, no rows in the tail, no prediction, too few sales in the tail.
    """
    left, right = names
    y = F.col("sales")
    stats = tail.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_tail"),
        F.sum("sales").alias("tail_sum"),
        F.count(a).alias("n_a"),
        F.count(b).alias("n_b"),
        M.mae(y, F.col(a)).alias(f"{left}_MAE"),
        M.mape(y, F.col(a)).alias(f"{left}_MAPE"),
        M.mae(y, F.col(b)).alias(f"{right}_MAE"),
        M.mape(y, F.col(b)).alias(f"{right}_MAPE"),
    )
    known = fitted.select(*PAIR).distinct().withColumn("has_model", F.lit(True))
    every = pairs.select(*PAIR).distinct().join(known, PAIR, "left").join(stats, PAIR, "left")
    reason = (
        F.when(F.col("has_model").isNull(), F.lit(f"no {left} model"))
        .when(F.col("n_tail").isNull(), F.lit("empty tail"))
        .when(F.col("n_a") == 0, F.lit(f"no {left} prediction"))
        .when(F.col("n_b") == 0, F.lit(f"no {right} prediction"))
        .when(F.col("tail_sum") < min_tail_sales, F.lit(f"tail_sum<{min_tail_sales:g}"))
    )
    return every.withColumns(
        {
            f"GAIN_{right}_vs_{left}_MAE": F.col(f"{left}_MAE") - F.col(f"{right}_MAE"),
            f"GAIN_{right}_vs_{left}_MAPE": F.col(f"{left}_MAPE") - F.col(f"{right}_MAPE"),
            "reason": reason,
        }
    ).drop("n_a", "n_b", "n_tail", "has_model")


def resampled_errors(held: DataFrame, freq: str = "M", skip_empty: bool = False) -> DataFrame:
    """MAE and MAPE per pair of weekly or monthly sums.

    A bin without rows is 0 against 0 and counts; `skip_empty` leaves such bins out.
    """
    bins = held if not skip_empty else held.withColumn("n", F.lit(1.0))
    values = ["sales", "y_pred"] + ["n"] * skip_empty
    binned = resample(bins, values, freq, "sum", PAIR)
    if skip_empty:
        binned = binned.filter("n > 0")
    return error_metrics(binned, {"": "y_pred"})


def compared(result: DataFrame) -> DataFrame:
    return result.filter(F.col("reason").isNull()).drop("reason")


def skipped(result: DataFrame) -> DataFrame:
    return result.filter(F.col("reason").isNotNull()).select(*PAIR, "reason")


def holdout_summary(held: DataFrame, models: dict[str, tuple[str, str]]) -> DataFrame:
    """As `model_summary`, for prediction columns of one frame, {model: (column, size hint)}:
    all of them in one pass."""
    named = {f"m{i}_": column for i, (column, _) in enumerate(models.values())}
    per_pair = error_metrics(held, named)
    means = per_pair.agg(
        *[F.avg(f"`{p}{m}`").alias(f"{p}{m}") for p in named for m in ("MAE", "MAPE_%")]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.col(f"{p}MAE").alias("MAE"),
                F.col(f"`{p}MAPE_%`").alias("MAPE"),
                F.lit(hint).alias("size_hint"),
            )
            for p, (model, (_, hint)) in zip(named, models.items())
        ]
    )
    return means.select(F.inline(rows))


def model_summary(runs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Mean MAE and MAPE of several metric tables: {model: (metrics, size hint)}."""
    parts = [
        df.agg(F.avg("MAE").alias("MAE"), F.avg("`MAPE_%`").alias("MAPE")).select(
            F.lit(model).alias("model"), "MAE", "MAPE", F.lit(hint).alias("size_hint")
        )
        for model, (df, hint) in runs.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
