"""Stock plan and money impact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions.service import z_from_service_level
from shelfcast.operators.evaluate import tail_profile
from shelfcast.operators.windows import last_rows, row_order
from shelfcast.schemas import PAIR


def stock_plan(
    df: DataFrame, tail: int = 30, lead_time_days: int = 2, z: float = 1.65
) -> DataFrame:
    """Safety stock and reorder point per pair from its last `tail` rows."""
    stats = last_rows(df.select(*PAIR, "date", "sales"), tail).groupBy(*PAIR).agg(
        F.avg("sales").alias("daily_mean"),
        F.when(F.count(F.lit(1)) > 1, F.stddev_samp("sales")).otherwise(F.lit(0.0)).alias(
            "daily_std"
        ),
    )
    days = F.lit(lead_time_days)
    stock = F.lit(z) * F.col("daily_std") * F.sqrt(days.cast("double"))
    return stats.select(
        *PAIR,
        "daily_mean",
        "daily_std",
        days.alias("lead_time_days"),
        F.lit(z).alias("service_z"),
        stock.alias("safety_stock"),
        (F.col("daily_mean") * days + stock).alias("reorder_point"),
    )


def first_metric(metrics: DataFrame, order: str = "MAE") -> DataFrame:
    """One metric row per pair, the smallest by `order` when there are several.

    A grouped minimum, so duplicates collapse before the shuffle.
    """
    best = F.min_by(F.col("`MAPE_%`"), F.col(order))
    return metrics.groupBy(*PAIR).agg(best.alias("model_MAPE_%"))


def add_model_mape(df: DataFrame, metrics: DataFrame | None) -> DataFrame:
    if metrics is None:
        return df.withColumn("model_MAPE_%", F.lit(None).cast("double"))
    return df.join(first_metric(metrics), PAIR, "left")


def add_prices(
    df: DataFrame, prices: DataFrame | None, store_override: bool = True
) -> DataFrame:
    """Price, margin and holding cost: store row (when allowed), family row, defaults.

    Several rows for one key collapse to the smallest, so nothing fans out.
    """
    fields = {
        "price": schemas.DEFAULT_PRICE,
        "margin_rate": schemas.DEFAULT_MARGIN,
        "holding_cost": schemas.DEFAULT_HOLDING,
    }
    if prices is None:
        return df.withColumns({c: F.lit(v) for c, v in fields.items()})
    per_store = "store_nbr" in prices.columns
    family_rows = prices.filter(F.col("store_nbr").isNull()) if per_store else prices
    by_family = family_rows.groupBy("family").agg(
        F.min(F.struct(*fields)).alias("_f")
    )
    out = df.join(by_family, "family", "left")
    use_store = per_store and store_override
    if use_store:
        by_store = (
            prices.filter(F.col("store_nbr").isNotNull())
            .groupBy(*PAIR)
            .agg(F.min(F.struct(*fields)).alias("_s"))
        )
        out = out.join(by_store, PAIR, "left")
    sources = {
        c: F.coalesce(*([F.col(f"_s.{c}")] if use_store else []), F.col(f"_f.{c}"), F.lit(v))
        for c, v in fields.items()
    }
    return out.withColumns(sources).drop("_f", "_s")


def _stock_and_point(sigma: Column, mean: Column, z: Column, days: int) -> tuple[Column, Column]:
    stock = z * sigma * F.lit(float(days) ** 0.5)
    return stock, mean * days + stock


def impact_columns(
    df: DataFrame, service_level: float = 0.95, lead_time_days: int = 2
) -> DataFrame:
    """Money columns from daily_mean, the two MAPEs and the price columns.

    A missing MAPE leaves its side NULL.
    """
    mean, z = F.col("daily_mean"), z_from_service_level(F.lit(service_level))
    out = df
    for side in ("naive", "model"):
        sigma = F.col(f"`{side}_MAPE_%`") / 100.0 * mean
        out = out.withColumn(f"sigma_{side}", sigma)
        stock, point = _stock_and_point(F.col(f"sigma_{side}"), mean, z, lead_time_days)
        out = out.withColumns({f"SS_{side}": stock, f"ROP_{side}": point})
        units = F.lit(1 - service_level) * mean * lead_time_days
        under = units * (F.col("margin_rate") * F.col("price"))
        out = out.withColumns(
            {
                f"under_cost_{side}": F.when(F.col(f"SS_{side}").isNotNull(), under),
                f"over_cost_{side}": F.col("holding_cost") * F.col(f"SS_{side}"),
            }
        )
    return out.withColumns(
        {
            "savings_under": F.col("under_cost_naive") - F.col("under_cost_model"),
            "savings_over_per_day": F.col("over_cost_naive") - F.col("over_cost_model"),
        }
    )


# Columns of the impact report, in order.
IMPACT_COLUMNS = [
    "store_nbr",
    "family",
    "daily_mean",
    "naive_MAPE_%",
    "model_MAPE_%",
    "sigma_naive",
    "sigma_model",
    "SS_naive",
    "SS_model",
    "ROP_naive",
    "ROP_model",
    "price",
    "margin_rate",
    "holding_cost",
    "under_cost_naive",
    "under_cost_model",
    "over_cost_naive",
    "over_cost_model",
    "savings_under",
    "savings_over_per_day",
]


def tail_mean(df: DataFrame, tail: int = 30) -> DataFrame:
    rows = last_rows(df.select(*PAIR, "date", "sales"), tail)
    return rows.groupBy(*PAIR).agg(F.coalesce(F.avg("sales"), F.lit(0.0)).alias("daily_mean"))


def impact_report(
    df: DataFrame,
    metrics: DataFrame | None,
    prices: DataFrame | None,
    tail: int = 30,
    valid_days: int = 28,
    service_level: float = 0.95,
    lead_time_days: int = 2,
    store_override: bool = True,
) -> DataFrame:
    """Naive against model, in money, for every pair."""
    base = tail_profile(df.select(*PAIR, *row_order(df), "sales"), tail, valid_days)
    priced = add_prices(add_model_mape(base, metrics), prices, store_override)
    out = impact_columns(priced, service_level, lead_time_days)
    return out.select(*[F.col(f"`{c}`") for c in IMPACT_COLUMNS])


def impact_summary(report: DataFrame) -> DataFrame:
    """Pair counts and total savings over the pairs that have a model MAPE."""
    has = F.col("`model_MAPE_%`").isNotNull()
    return report.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(has).alias("pairs_with_model"),
        F.count_if(~has).alias("pairs_without_model"),
        F.coalesce(F.sum(F.when(has, F.col("savings_under"))), F.lit(0.0)).alias("savings_under"),
        F.coalesce(F.sum(F.when(has, F.col("savings_over_per_day"))), F.lit(0.0)).alias(
            "savings_over_per_day"
        ),
    )


def pair_money(
    df: DataFrame,
    metrics: DataFrame | None,
    price: float = schemas.DEFAULT_PRICE,
    margin_rate: float = schemas.DEFAULT_MARGIN,
    holding_cost: float = schemas.DEFAULT_HOLDING,
    lead_time_days: int = 2,
    service_level: float = 0.95,
    default_mape: float = 20.0,
    tail: int = 30,
) -> DataFrame:
    """Money metrics with given prices; filter `df` to one pair for a single answer."""
    base = add_model_mape(tail_mean(df, tail), metrics)
    mean = F.col("daily_mean")
    mape = F.coalesce("model_MAPE_%", F.lit(default_mape))
    days = max(int(lead_time_days), 1)
    out = base.withColumns(
        {"mape_pct": mape, "sigma": F.greatest(mape / 100.0 * mean, F.lit(0.0))}
    )
    z = z_from_service_level(F.lit(service_level))
    stock, point = _stock_and_point(F.col("sigma"), mean, z, days)
    under = F.lit(1 - service_level) * mean * days * F.lit(margin_rate * price)
    return out.select(
        *PAIR,
        "daily_mean",
        "mape_pct",
        "sigma",
        stock.alias("safety_stock"),
        point.alias("reorder_point"),
        under.alias("under_cost"),
        (F.lit(holding_cost) * stock).alias("over_cost"),
    )
