"""Forecast models: one regression per pair by grouped sums, and global MLlib models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import metrics as M
from shelfcast.functions.vectors import coerce_feature, linear_score
from shelfcast.operators.evaluate import add_baselines, add_gains, error_metrics
from shelfcast.operators.ranks import grouped_quantiles
from shelfcast.operators.select import encode_categories
from shelfcast.operators.split import (
    add_holdout,
    basic_gate,
    fold_columns,
    fold_gate,
    fold_training,
    gated_pairs,
    inside_folds,
    split_counts,
    with_last,
)
from shelfcast.plans.features import FEATURE_GROUPS
from shelfcast.schemas import PAIR
from shelfcast.session import materialize

# ------------------------------------------------------------------ trend per pair


def fit_trend(
    df: DataFrame, is_train: Column, keys: Sequence[str] = PAIR, y: str = "sales", x: str = "trend"
) -> DataFrame:
    """Slope and intercept per group from training rows; one grouped aggregate."""
    y_train, x_train = F.when(is_train, F.col(y)), F.when(is_train, F.col(x))
    return df.groupBy(*keys).agg(
        F.regr_slope(y_train, x_train).alias("slope"),
        F.regr_intercept(y_train, x_train).alias("intercept"),
    )


def fit_gated_trend(split: DataFrame) -> DataFrame:
    """Slope and intercept of the pairs with enough holdout rows, in one grouped pass."""
    train = ~F.col("is_valid")
    y, x = F.when(train, F.col("sales")), F.when(train, F.col("trend"))
    fitted = split.groupBy(*PAIR).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.count_if("is_valid").alias("n_valid"),
    )
    return fitted.filter(basic_gate()).drop("n_valid")


def trend_prediction(x: str = "trend") -> Column:
    return F.col("intercept") + F.col("slope") * F.col(x)


def score_trend(df: DataFrame, params: DataFrame, name: str = "y_pred") -> DataFrame:
    return df.join(params, PAIR).withColumn(name, trend_prediction()).drop("slope", "intercept")


def residual_quantiles(
    df: DataFrame, params: DataFrame, is_train: Column, quantiles: Sequence[float] = (0.5, 0.9)
) -> DataFrame:
    """Quantiles of the training residuals per pair, as (quantile, shift) rows.

    They are exact and no pair's residuals are gathered: see `grouped_quantiles`. Every
    fitted pair is listed; without training rows the shift is NULL.
    """
    residual = F.when(is_train, F.col("sales") - F.col("y_pred")).alias("residual")
    rows = materialize(score_trend(df, params).select(*PAIR, residual), "residuals")
    found = grouped_quantiles(rows, "residual", quantiles).withColumnRenamed("value", "shift")
    qs = F.array(*[F.lit(float(q)) for q in quantiles])
    every = rows.select(*PAIR).distinct().withColumn("quantile", F.explode(qs))
    return every.join(found, [*PAIR, "quantile"], "left")


# ------------------------------------------------------------------ metric table

# Columns of the metric table, in order.
METRIC_COLUMNS = [
    "store_nbr",
    "family",
    "MAE",
    "MAPE_%",
    "CV_MAE",
    "CV_MAPE_%",
    "NAIVE_LAG7_MAE",
    "NAIVE_LAG7_MAPE_%",
    "NAIVE_MA7_MAE",
    "NAIVE_MA7_MAPE_%",
    "MAE_GAIN_vs_LAG7",
    "MAE_GAIN_vs_MA7",
]


def trend_cross_validation(
    df: DataFrame,
    folds: int,
    valid_days: int = 28,
    step_days: int = 28,
    mode: str = "outside",
) -> DataFrame:
    """MAE and MAPE of the trend model per pair and fold that passes the row gate.

    All folds of a pair are fitted by one aggregate of conditional sums, with a map-side
    part; only rows inside a fold are repeated, once for each fold that holds them.
    """
    bounded = with_last(df)
    y, x = F.col("sales"), F.col("trend")
    fits = []
    for fold in range(folds):
        inside, before = fold_columns(fold, folds, valid_days, step_days)
        train = fold_training(inside, before, mode)
        own_y, own_x = F.when(train, y), F.when(train, x)
        fits.append(
            F.struct(
                F.regr_slope(own_y, own_x).alias("slope"),
                F.regr_intercept(own_y, own_x).alias("intercept"),
            )
        )
    params = bounded.groupBy(*PAIR).agg(F.array(*fits).alias("fits"))
    scored = inside_folds(bounded, folds, valid_days, step_days).join(params, PAIR)
    fit = F.element_at("fits", F.col("fold") + 1)
    scored = scored.withColumn("p", fit["intercept"] + fit["slope"] * x)
    return (
        scored.groupBy(*PAIR, "fold")
        .agg(
            M.mae(y, F.col("p")).alias("MAE"),
            M.mape(y, F.col("p")).alias("MAPE_%"),
            F.count(F.lit(1)).alias("n_fold"),
            F.first("n_rows").alias("n_rows"),
        )
        .filter(fold_gate())
    )


def baseline_cross_validation(
    df: DataFrame, folds: int, valid_days: int = 28, step_days: int = 28
) -> DataFrame:
    """The same folds for the two baselines, which need no training."""
    inside = inside_folds(with_last(add_baselines(df)), folds, valid_days, step_days)
    counted = inside.groupBy(*PAIR, "fold").agg(
        M.mae(F.col("sales"), F.col("naive_lag7")).alias("LAG7_MAE"),
        M.mae(F.col("sales"), F.col("naive_ma7")).alias("MA7_MAE"),
        F.count(F.lit(1)).alias("n_fold"),
        F.first("n_rows").alias("n_rows"),
    )
    return counted.filter(fold_gate())


def mean_over_folds(fold_metrics: DataFrame) -> DataFrame:
    return fold_metrics.groupBy(*PAIR).agg(
        F.avg("MAE").alias("CV_MAE"), F.avg("`MAPE_%`").alias("CV_MAPE_%")
    )


def holdout_predictions(df: DataFrame, valid_days: int = 28) -> DataFrame:
    """Holdout rows of every pair that passes the gate, with the trend forecast and
    the two baselines. Needs `trend`.

    The fit and the gate are grouped sums with a map-side part, one row per pair; only the
    baselines, which are positional, order the rows of a pair.
    """
    fitted = fit_gated_trend(add_holdout(df, valid_days))
    held = add_holdout(add_baselines(df), valid_days).filter("is_valid").join(fitted, PAIR)
    return held.withColumn("y_pred", trend_prediction()).drop("slope", "intercept")


def metrics_per_pair(
    df: DataFrame, valid_days: int = 28, folds: int = 0, step_days: int = 28
) -> DataFrame:
    """Metric row per pair: model, folds, baselines and gains."""
    held = holdout_predictions(df, valid_days)
    base = error_metrics(
        held, {"": "y_pred", "NAIVE_LAG7_": "naive_lag7", "NAIVE_MA7_": "naive_ma7"}
    )
    if folds > 0:
        cv = mean_over_folds(trend_cross_validation(df, folds, valid_days, step_days))
        base = base.join(cv, PAIR, "left")
    else:
        base = base.withColumns(
            {c: F.lit(None).cast("double") for c in ("CV_MAE", "CV_MAPE_%")}
        )
    return add_gains(base).select(*[F.col(f"`{c}`") for c in METRIC_COLUMNS])


# ------------------------------------------------------------------ ridge per pair


def _upper(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def ridge_centres(df: DataFrame, features: Sequence[str], is_train: Column) -> DataFrame:
    """(pair, centre): the means of the features and of sales over the training rows."""
    x = [coerce_feature(F.col(c)) for c in features] + [F.col("sales")]
    rows = df.filter(is_train & F.col("sales").isNotNull())
    return rows.groupBy(*PAIR).agg(F.array(*[F.avg(v) for v in x]).alias("centre"))


def ridge_sums(
    df: DataFrame,
    features: Sequence[str],
    is_train: Column,
    keys: Sequence[str] = PAIR,
    centres: DataFrame | None = None,
) -> DataFrame:
    """Per pair: row count, sums of x, y, the upper triangle of X'X, and X'y.

    Plain sums with a map-side part: one row per task and pair is shuffled, and
    what the solver sees has a size set by the number of features alone. With `centres` the
    sums are those of the distances to them, and `centre` is one more column: products of
    large values then lose no digits, and sums about the same centres can be added and
    subtracted.
    """
    x = [coerce_feature(F.col(c)) for c in features] + [F.col("sales")]
    rows = df.filter(is_train & F.col("sales").isNotNull())
    more = []
    if centres is not None:
        distances = F.array(*[v - F.col("centre")[i] for i, v in enumerate(x)])
        rows = rows.join(centres, PAIR).select(*keys, "centre", distances.alias("_x"))
        x = [F.col("_x")[i] for i in range(len(x))]
        more = [F.first("centre").alias("centre")]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(v) for v in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in _upper(len(x))]).alias("g"),
        *more,
    )


def ridge_weights(
    sums: DataFrame, masks: dict[str, list[bool]], alpha: float, keys: Sequence[str] = PAIR
) -> DataFrame:
    """Solve every pair once per mask: (pair, setting, weights, intercept).

    `sums` are about the `centre` of the pair.
    """
    settings = {name: np.array(mask, dtype=bool) for name, mask in masks.items()}

    # nested, so that it travels with the task: workers need numpy and pandas only
    def solve_one(
        n: float, s: np.ndarray, g: np.ndarray, centre: np.ndarray, keep: np.ndarray, alpha: float
    ) -> np.ndarray:
        """Ridge on standardised columns from the sums of one pair; weights, then intercept."""
        k = len(s) - 1
        gram = np.zeros((k + 1, k + 1))
        rows, cols = np.triu_indices(k + 1)
        gram[rows, cols] = g
        gram[cols, rows] = g
        off = s / n
        mean = centre + off
        cov = gram / n - np.outer(off, off)
        sd = np.sqrt(np.clip(np.diag(cov)[:k], 0.0, None))
        # a column that does not vary gets no weight
        live = keep & (sd > 1e-9 * np.maximum(1.0, np.abs(mean[:k])))
        weights = np.zeros(k + 1)
        if live.any():
            d = sd[live]
            corr = cov[:k, :k][np.ix_(live, live)] / np.outer(d, d)
            rhs = cov[:k, k][live] / d
            beta = np.linalg.solve(corr + (alpha / n) * np.eye(len(d)), rhs)
            weights[:k][live] = beta / d
        weights[k] = mean[k] - weights[:k] @ mean[:k]
        return weights

    @F.pandas_udf("array<array<double>>")
    def solve(n: pd.Series, s: pd.Series, g: pd.Series, centre: pd.Series) -> pd.Series:
        out = []
        for count, *arrays in zip(n, s, g, centre):
            sums = [np.asarray(a, float) for a in arrays]
            out.append([solve_one(float(count), *sums, m, alpha).tolist() for m in settings.values()])
        return pd.Series(out)

    k = len(next(iter(masks.values())))
    solved = sums.select(
        *keys,
        F.posexplode(solve("n", "s", "g", "centre")).alias("pos", "w"),
    )
    names = F.array(*[F.lit(n) for n in masks])
    return solved.select(
        *keys,
        F.element_at(names, F.col("pos") + 1).alias("setting"),
        F.slice("w", 1, k).alias("weights"),
        F.element_at("w", k + 1).alias("intercept"),
    )


def fit_ridge(
    df: DataFrame, features: Sequence[str], is_train: Column, alpha: float = 1.0
) -> DataFrame:
    """(pair, weights, intercept) of a ridge regression on `features`."""
    sums = ridge_sums(df, features, is_train, centres=ridge_centres(df, features, is_train))
    return ridge_weights(sums, {"full": [True] * len(features)}, alpha).drop("setting")


def score_linear(
    df: DataFrame, params: DataFrame, features: Sequence[str], name: str = "y_pred"
) -> DataFrame:
    vector = F.array(*[coerce_feature(F.col(c)) for c in features])
    scored = df.join(params, PAIR)
    return scored.withColumn(
        name, linear_score(vector, F.col("weights"), F.col("intercept"))
    ).drop("weights", "intercept")


def ridge_metrics(
    df: DataFrame, features: Sequence[str], valid_days: int = 28, alpha: float = 1.0
) -> DataFrame:
    split = add_holdout(df, valid_days)
    params = fit_ridge(split, features, ~F.col("is_valid"), alpha)
    gate = split_counts(split).filter(basic_gate()).select(*PAIR)
    held = split.filter("is_valid").join(gate, PAIR, "left_semi")
    return error_metrics(score_linear(held, params, features), {"": "y_pred"})


def ridge_cross_validation(
    df: DataFrame,
    features: Sequence[str],
    folds: int,
    valid_days: int = 28,
    step_days: int = 28,
    alpha: float = 1.0,
) -> DataFrame:
    """MAE and MAPE of the ridge model per pair and fold, trained on the rows outside.

    The sums outside a fold are those of the whole pair minus those of the fold, so every
    row is summed once, and again for each fold that holds it.
    """
    keys = [*PAIR, "fold"]
    inside = inside_folds(with_last(df), folds, valid_days, step_days)
    centres = materialize(ridge_centres(df, features, F.lit(True)), "ridge-centres")
    whole = ridge_sums(df, features, F.lit(True), centres=centres)
    whole = whole.toDF(*PAIR, "all_n", "all_s", "all_g", "centre")
    own = ridge_sums(inside, features, F.lit(True), keys, centres).drop("centre")

    def minus(whole_sum: str, fold_sum: str) -> Column:
        return F.zip_with(whole_sum, fold_sum, lambda a, b: a - b)

    outside = own.join(whole, PAIR).select(
        *keys,
        (F.col("all_n") - F.col("n")).alias("n"),
        minus("all_s", "s").alias("s"),
        minus("all_g", "g").alias("g"),
        "centre",
    )
    masks = {"full": [True] * len(features)}
    weights = ridge_weights(outside.filter("n > 0"), masks, alpha, keys).drop("setting")
    vector = F.array(*[coerce_feature(F.col(c)) for c in features])
    scored = inside.join(weights, keys).withColumn(
        "p", linear_score(vector, F.col("weights"), F.col("intercept"))
    )
    return (
        scored.groupBy(*keys)
        .agg(
            M.mae(F.col("sales"), F.col("p")).alias("MAE"),
            M.mape(F.col("sales"), F.col("p")).alias("MAPE_%"),
            F.count(F.lit(1)).alias("n_fold"),
            F.first("n_rows").alias("n_rows"),
        )
        .filter(fold_gate())
    )


def ablation(
    df: DataFrame,
    features: Sequence[str],
    valid_days: int = 28,
    alpha: float = 1.0,
    groups: dict[str, list[str]] = FEATURE_GROUPS,
) -> DataFrame:
    """Holdout metrics of the full ridge and of it without each feature group.

    The sums of the full feature set contain those of every subset, so all settings
    are solved from one pass over the training rows and scored in one more.
    """
    masks = {"full": [True] * len(features)}
    for name, members in groups.items():
        mask = [f not in members for f in features]
        if not all(mask):
            masks[f"w/o {name}"] = mask
    split = add_holdout(df, valid_days)
    train = ~F.col("is_valid")
    sums = ridge_sums(split, features, train, centres=ridge_centres(split, features, train))
    weights = ridge_weights(sums, masks, alpha)
    per_pair = weights.groupBy(*PAIR).agg(
        F.collect_list(F.struct("setting", "weights", "intercept")).alias("settings")
    )
    gate = split_counts(split).filter(basic_gate()).select(*PAIR)
    held = split.filter("is_valid").join(gate, PAIR, "left_semi")
    vector = F.array(*[coerce_feature(F.col(c)) for c in features])
    scored = (
        held.select(*PAIR, "sales", vector.alias("x"))
        .join(per_pair, PAIR)
        .select(*PAIR, "sales", "x", F.inline("settings"))
        .withColumn("p", linear_score(F.col("x"), F.col("weights"), F.col("intercept")))
    )
    return scored.groupBy(*PAIR, "setting").agg(
        M.mae(F.col("sales"), F.col("p")).alias("MAE"),
        M.mape(F.col("sales"), F.col("p")).alias("MAPE_%"),
        F.count(F.lit(1)).alias("n_val"),
    )


# ------------------------------------------------------------------ attribution


def trend_attribution(df: DataFrame, params: DataFrame, sample: DataFrame) -> DataFrame:
    """Mean |slope * (x - mean x)| over `sample` rows, the mean taken over `df`."""
    means = df.groupBy(*PAIR).agg(F.avg("trend").alias("mu"))
    effect = F.abs(F.col("slope") * (F.col("trend") - F.col("mu")))
    return (
        sample.join(params, PAIR)
        .join(means, PAIR)
        .groupBy(*PAIR)
        .agg(F.avg(effect).alias("mean_abs_effect"))
        .select(*PAIR, F.lit("trend").alias("feature"), "mean_abs_effect")
    )


def linear_attribution(
    df: DataFrame, params: DataFrame, features: Sequence[str], sample: DataFrame
) -> DataFrame:
    """Mean |weight * (x - mean x)| per pair and feature over `sample` rows."""
    means = df.groupBy(*PAIR).agg(
        F.array(*[F.avg(coerce_feature(F.col(c))) for c in features]).alias("mu")
    )
    effects = [
        F.avg(
            F.abs(
                F.element_at("weights", i + 1)
                * (coerce_feature(F.col(c)) - F.element_at("mu", i + 1))
            )
        )
        for i, c in enumerate(features)
    ]
    joined = sample.join(params, PAIR).join(means, PAIR)
    wide = joined.groupBy(*PAIR).agg(F.array(*effects).alias("e"))
    names = F.array(*[F.lit(f) for f in features])
    rows = wide.select(*PAIR, F.posexplode("e").alias("i", "mean_abs_effect"))
    return rows.select(
        *PAIR, F.element_at(names, F.col("i") + 1).alias("feature"), "mean_abs_effect"
    )


def top_features(importances: DataFrame, k: int = 15, score: str = "importance") -> DataFrame:
    return importances.orderBy(F.col(score).desc(), "feature").limit(k)


# ------------------------------------------------------------------ global MLlib models


def target_column(log1p: bool) -> Column:
    return F.log1p("sales") if log1p else F.col("sales")


def inverse_target(prediction: Column, log1p: bool) -> Column:
    return F.expm1(prediction) if log1p else prediction


def sample_weight(enabled: bool) -> Column:
    """1 / max(y, 1): makes an absolute loss behave like a relative one."""
    return 1.0 / F.greatest(F.col("sales"), F.lit(1.0)) if enabled else F.lit(1.0)


def model_frame(
    df: DataFrame,
    features: Sequence[str],
    categories: Sequence[str] = ("store_nbr", "family"),
    valid_days: int = 28,
    scope: str = "global",
    log1p: bool = False,
    mape_weighting: bool = False,
    gate: Column | None = None,
) -> tuple[DataFrame, list[str]]:
    """Rows ready for MLlib: numeric inputs, coded categories, label, weight, split.

    With `gate` only the pairs whose row counts pass it take part.
    """
    split = add_holdout(df, valid_days, scope)
    if gate is not None:
        split = split.join(gated_pairs(split, gate), PAIR, "left_semi")
    coded = encode_categories(split, list(categories))
    codes = [f"{c}_code" for c in categories]
    inputs = [*features, *codes]
    frame = coded.withColumns({c: coerce_feature(F.col(c)) for c in inputs}).select(
        *PAIR,
        "date",
        "sales",
        "is_valid",
        *[c for c in inputs if c not in PAIR],
        target_column(log1p).alias("label"),
        sample_weight(mape_weighting).alias("weight"),
    )
    return frame, inputs


def boosted_trees(
    inputs: Sequence[str],
    max_iter: int = 100,
    step: float = 0.1,
    depth: int = 6,
    subsample: float = 0.9,
    seed: int = 42,
    leaf: int = 1,
    columns: float = 1.0,
    gain: float = 0.0,
    tolerance: float = 0.01,
) -> Pipeline:
    """Gradient boosting on absolute loss that stops when the holdout gets no better.

    `leaf` is the least number of rows of a leaf, `columns` the share of inputs a split
    chooses from, `gain` the least gain of a split; a round that lowers the holdout error by
    less than the share `tolerance` is the last.
    """
    trees = GBTRegressor(
        featuresCol="inputs",
        labelCol="label",
        weightCol="weight",
        lossType="absolute",
        maxIter=max_iter,
        stepSize=step,
        maxDepth=depth,
        subsamplingRate=subsample,
        validationIndicatorCol="is_valid",
        minInstancesPerNode=leaf,
        featureSubsetStrategy="all" if columns >= 1 else str(columns),
        minInfoGain=gain,
        validationTol=tolerance,
        seed=seed,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="inputs"), trees])


def random_forest(
    inputs: Sequence[str],
    trees: int = 500,
    depth: int = 12,
    leaf: int = 3,
    seed: int = 42,
    bootstrap: bool = True,
) -> Pipeline:
    forest = RandomForestRegressor(
        featuresCol="inputs",
        labelCol="label",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        bootstrap=bootstrap,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="inputs"), forest])


def generalized_linear(
    inputs: Sequence[str], family: str = "tweedie", power: float = 1.2, reg: float = 0.01
) -> Pipeline:
    """Poisson or Tweedie regression with a log link on standardised inputs."""
    options = {"family": family, "regParam": reg, "maxIter": 25}
    if family == "tweedie":
        options.update(variancePower=power, linkPower=0.0)
    else:
        options.update(link="log")
    glm = GeneralizedLinearRegression(featuresCol="inputs", labelCol="label", **options)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="inputs", withMean=True),
            glm,
        ]
    )


def fit_global(frame: DataFrame, pipeline: Pipeline, uses_holdout: bool = False):
    """Fit on training rows; `uses_holdout` keeps holdout rows for early stopping."""
    return pipeline.fit(frame if uses_holdout else frame.filter(~F.col("is_valid")))


def predict_global(model, frame: DataFrame, log1p: bool = False) -> DataFrame:
    scored = model.transform(frame)
    return scored.withColumn("y_pred", inverse_target(F.col("prediction"), log1p)).drop(
        "prediction", "inputs", "raw"
    )


def importances(model, inputs: Sequence[str], spark) -> DataFrame:
    """Feature importances of a fitted tree model; as long as the input list."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(inputs, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


# ------------------------------------------------------------------ search


def parameter_candidates(
    trials: int, seed: int = 42, rounds: tuple[int, int] = (300, 3000)
) -> list[dict[str, float]]:
    """Seeded random settings of the boosted trees, `rounds` from least to most."""
    rng = np.random.default_rng(seed)
    return [
        {
            "max_iter": int(rng.integers(rounds[0], rounds[1] + 1)),
            "step": float(np.exp(rng.uniform(np.log(0.05), np.log(0.3)))),
            "depth": int(rng.integers(3, 7)),
            "subsample": float(rng.uniform(0.6, 1.0)),
        }
        for _ in range(trials)
    ]


def search(frame: DataFrame, inputs: Sequence[str], candidates: list[dict]) -> DataFrame:
    """One row per candidate with its holdout MAE, best first.

    `frame` is read once per candidate: hand in a written table.
    """
    spark = frame.sparkSession
    rows = []
    for trial, params in enumerate(candidates):
        model = fit_global(frame, boosted_trees(inputs, **params), uses_holdout=True)
        held = predict_global(model, frame.filter("is_valid"))
        score = held.agg(M.mae(F.col("sales"), F.col("y_pred"))).first()[0]
        used = model.stages[-1].getNumTrees
        rows.append((trial, {k: float(v) for k, v in params.items()}, int(used), float(score)))
    schema = "trial int, params map<string,double>, best_iteration int, MAE double"
    return spark.createDataFrame(rows, schema).orderBy("MAE", "trial")
