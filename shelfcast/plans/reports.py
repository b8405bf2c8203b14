"""Metric reports and the error leaderboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.evaluate import add_wmape, tail_totals
from shelfcast.operators.select import members, recent, worst
from shelfcast.schemas import PAIR

# Columns of the leaderboard, in order.
LEADERBOARD_COLUMNS = [
    "store_nbr",
    "family",
    "MAE",
    "MAPE_%",
    "wMAPE_%_est",
    "NAIVE_LAG7_MAE",
    "NAIVE_MA7_MAE",
]


def mean_by(metrics: DataFrame, key: str) -> DataFrame:
    """Mean MAE and MAPE per key, NULL keys left out, best first."""
    return (
        metrics.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg("MAE").alias("MAE"), F.avg("`MAPE_%`").alias("MAPE_%"))
        .orderBy("MAE", key)
    )


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Row count and mean metrics; fold means skip pairs without folds."""
    return metrics.agg(
        F.count(F.lit(1)).alias("models"),
        F.avg("MAE").alias("mean_MAE"),
        F.avg("`MAPE_%`").alias("mean_MAPE"),
        F.avg("CV_MAE").alias("mean_CV_MAE"),
        F.avg("`CV_MAPE_%`").alias("mean_CV_MAPE"),
    )


def baseline_comparison(metrics: DataFrame, n: int = 50) -> DataFrame:
    naive = [c for c in metrics.columns if c.startswith("NAIVE_")]
    cols = [*PAIR, "MAE", *[f"`{c}`" for c in naive]]
    return worst(metrics.select(*[F.col(c) for c in cols]), "MAE", n, best=True)


def metrics_report(metrics: DataFrame, n: int = 50) -> dict[str, DataFrame]:
    """The five tables of the metrics report."""
    return {
        "summary": metric_summary(metrics),
        "by_store": mean_by(metrics, "store_nbr"),
        "by_family": mean_by(metrics, "family"),
        "worst": worst(metrics.select(*PAIR, "MAE", F.col("`MAPE_%`")), "MAE", n),
        "baselines": baseline_comparison(metrics, n),
    }


def leaderboard(
    metrics: DataFrame,
    sales: DataFrame,
    metric: str = "MAE",
    n: int = 100,
    stores: Sequence[int] | None = None,
    families: Sequence[str] | None = None,
    valid_days: int = 28,
) -> DataFrame:
    """Worst pairs by metric with an estimated wMAPE over the last days."""
    chosen = members(metrics, stores, families)
    totals = tail_totals(recent(sales, valid_days))
    ranked = worst(add_wmape(chosen, totals), metric, n)
    return ranked.select(*[F.col(f"`{c}`") for c in LEADERBOARD_COLUMNS])
