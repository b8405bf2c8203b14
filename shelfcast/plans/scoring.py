"""Model registry table and batch scoring of requests against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.service import P90_Z, z_from_service_level
from shelfcast.functions.text import model_key
from shelfcast.functions.vectors import coerce_feature, features_to_vector, linear_score
from shelfcast.schemas import PAIR

NOT_FOUND = "Model not found"
NO_QUANTILES = "No quantile models found"
PARAM_COLUMNS = ["features", "weights", "intercept"]


def registry_from_trend(params: DataFrame, quantiles: DataFrame | None = None) -> DataFrame:
    """Registry rows keyed by the raw pair: a point model, and one row per quantile."""
    slope = F.array(F.col("slope"))
    point = params.filter(F.col("slope").isNotNull()).select(
        *PAIR,
        F.lit("trend").alias("kind"),
        F.lit(None).cast("double").alias("quantile"),
        F.array(F.lit("trend")).alias("features"),
        slope.alias("weights"),
        "intercept",
    )
    if quantiles is None:
        return point
    shifted = params.filter(F.col("slope").isNotNull()).join(quantiles, PAIR)
    return point.unionByName(
        shifted.select(
            *PAIR,
            F.lit("quantile").alias("kind"),
            "quantile",
            F.array(F.lit("trend")).alias("features"),
            slope.alias("weights"),
            (F.col("intercept") + F.col("shift")).alias("intercept"),
        )
    )


def point_models(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("quantile").isNull()).select(*PAIR, "kind", *PARAM_COLUMNS)


def quantile_models(registry: DataFrame) -> DataFrame:
    """Per pair, a map quantile -> (weights, intercept); at most 99 entries."""
    entry = F.struct(
        F.col("quantile"), F.struct(*[F.col(c) for c in PARAM_COLUMNS]).alias("model")
    )
    return (
        registry.filter(F.col("quantile").isNotNull())
        .groupBy(*PAIR)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("by_quantile"))
    )


def _predict(features: Column, model: Column) -> Column:
    vector = features_to_vector(features, model["features"])
    return linear_score(vector, model["weights"], model["intercept"])


def score_requests(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests with `pred_qty`, `used_features` and `error` (NULL when scored)."""
    joined = requests.join(point_models(registry), PAIR, "left")
    found = F.col("intercept").isNotNull()
    vector = features_to_vector(F.col("request"), F.col("features"))
    score = linear_score(vector, F.col("weights"), F.col("intercept"))
    return joined.withColumns(
        {
            "pred_qty": F.when(found, score),
            "used_features": F.col("features"),
            "error": F.when(~found, F.lit(NOT_FOUND)),
        }
    ).drop("kind", *PARAM_COLUMNS)


def score_quantiles(
    requests: DataFrame, registry: DataFrame, quantiles: Sequence[float] = (0.5, 0.9)
) -> DataFrame:
    """Requests with a map quantile -> forecast over the available ones, or an error."""
    base = point_models(registry).select(*PAIR, F.col("features").alias("used_features"))
    joined = requests.join(base, PAIR, "left").join(quantile_models(registry), PAIR, "left")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    available = F.filter(wanted, lambda q: F.try_element_at("by_quantile", q).isNotNull())
    forecasts = F.map_from_entries(
        F.transform(
            available,
            lambda q: F.struct(
                q.cast("string"), _predict(F.col("request"), F.try_element_at("by_quantile", q))
            ),
        )
    )
    no_base = F.col("used_features").isNull()
    none = no_base | F.col("by_quantile").isNull() | (F.size(available) == 0)
    return joined.withColumns(
        {
            "quantiles": F.when(~none, forecasts),
            "error": F.when(no_base, F.lit(NOT_FOUND)).when(none, F.lit(NO_QUANTILES)),
        }
    ).drop("by_quantile")


def reorder_points(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Safety stock and reorder point per request.

    Spread comes from the 0.5 and 0.9 forecasts when the pair has both, else a
    quarter of the mean. `lead_time_days`, `service_level` and `service_level_z`
    of the request are used when present.
    """
    have = set(requests.columns)

    def given(name: str, kind: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(kind)

    scored = score_requests(requests, registry)
    joined = scored.filter(F.col("error").isNull()).join(quantile_models(registry), PAIR, "left")

    def forecast(q: float) -> Column:
        model = F.try_element_at("by_quantile", F.lit(q))
        return F.when(model.isNotNull(), _predict(F.col("request"), model))

    days = F.greatest(F.coalesce(given("lead_time_days", "int"), F.lit(2)), F.lit(1))
    z = F.coalesce(
        given("service_level_z", "double"), z_from_service_level(given("service_level", "double"))
    )
    out = joined.withColumns({"p50": forecast(0.5), "p90": forecast(0.9)})
    both = F.col("p50").isNotNull() & F.col("p90").isNotNull()
    spread = F.greatest((F.col("p90") - F.col("p50")) / P90_Z, F.lit(0.0))
    out = out.withColumns(
        {
            "quantiles_used": both,
            "daily_mean": F.when(both, F.col("p50")).otherwise(F.col("pred_qty")),
            "sigma_daily": F.when(both, spread).otherwise(
                F.greatest(0.25 * F.col("pred_qty"), F.lit(0.0))
            ),
            "lead_time_days": days,
            "service_level_z": z,
        }
    )
    stock = F.col("service_level_z") * F.col("sigma_daily") * F.sqrt("lead_time_days")
    return out.withColumn("safety_stock", stock).select(
        *PAIR,
        "daily_mean",
        "sigma_daily",
        "lead_time_days",
        "service_level_z",
        "safety_stock",
        (F.col("daily_mean") * F.col("lead_time_days") + F.col("safety_stock")).alias(
            "reorder_point"
        ),
        "used_features",
        "quantiles_used",
    )


def score_with_fallback(
    requests: DataFrame, registry: DataFrame, global_model: DataFrame
) -> DataFrame:
    """Per-pair model first, else the global one; `source` tells which.

    `global_model` has one row, read as a scalar; nothing is cross-joined.
    """
    packed = global_model.select(F.struct(*PARAM_COLUMNS).alias("m"))
    scored = score_requests(requests, registry).withColumn("_global", packed.scalar())
    fallback = _predict(F.col("request"), F.col("_global"))
    return scored.withColumns(
        {
            "source": F.when(F.col("error").isNull(), F.lit("pair")).otherwise(F.lit("global")),
            "pred_qty": F.coalesce("pred_qty", fallback),
        }
    ).drop("error", "used_features", "_global")


def registry_listing(registry: DataFrame) -> DataFrame:
    """Per pair: key, kinds and available quantiles."""
    return (
        registry.groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("n_models"),
            F.array_sort(F.collect_set("quantile")).alias("quantiles"),
        )
        .withColumn("model_key", model_key(F.col("store_nbr"), F.col("family")))
    )


def request_from_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn feature rows into requests: a map of the named columns, text as 0.0."""
    entries = []
    for n in names:
        entries += [F.lit(n), coerce_feature(F.col(n), df.schema[n].dataType)]
    return df.select(*PAIR, "date", F.create_map(*entries).alias("request"))


def backtest(
    rows: DataFrame, registry: DataFrame, names: Sequence[str], y: str = "sales"
) -> DataFrame:
    """Actual, point forecast and the 0.5 / 0.9 forecasts for the given feature rows."""
    asked = request_from_features(rows, names).withColumn("_q", F.col("request"))
    point = score_requests(asked, registry).filter(F.col("error").isNull())
    both = score_quantiles(point.drop("used_features", "error"), registry, (0.5, 0.9))
    scored = both.select(
        *PAIR,
        "date",
        "pred_qty",
        F.try_element_at("quantiles", F.lit("0.5")).alias("p50"),
        F.try_element_at("quantiles", F.lit("0.9")).alias("p90"),
    )
    return rows.select(*PAIR, "date", y).join(scored, [*PAIR, "date"])
