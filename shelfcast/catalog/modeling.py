"""Models, scoring, comparison; per-pair work and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.base import query
from shelfcast.catalog.settings import BOOSTING, FOLDS, FOREST, SEARCH_TRIALS, STEP_DAYS, VALID_DAYS
from shelfcast.catalog.sql import ape, mae_mape
from shelfcast.operators import evaluate as E
from shelfcast.operators import windows as W
from shelfcast.operators.split import add_holdout, forest_gate
from shelfcast.plans import attribution, compare, models, quantiles, scoring, validation
from shelfcast.schemas import PAIR
from shelfcast.session import fresh_path, materialize
from shelfcast.streaming import scoring as stream

PAIR_COLS = "store_nbr:i family:s"
KEY = "date:d store_nbr:i family:s"
METRIC_COLS = (
    f"{PAIR_COLS} MAE:f MAPE_%:f CV_MAE:f CV_MAPE_%:f NAIVE_LAG7_MAE:f NAIVE_LAG7_MAPE_%:f"
    " NAIVE_MA7_MAE:f NAIVE_MA7_MAPE_%:f MAE_GAIN_vs_LAG7:f MAE_GAIN_vs_MA7:f"
)
RIDGE = [
    "onpromotion",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "trend",
    "is_holiday",
    "transactions",
    "sales_lag_1",
    "sales_lag_7",
    "sales_rollmean_7",
    "sales_rollmean_30",
]


def written_features(s):
    """Model columns as a written table, for models that pass over them repeatedly."""
    return materialize(s.features.select(*PAIR, "date", "sales", *RIDGE), "features")


def written_frame(s, **options):
    frame, inputs = models.model_frame(s.features, RIDGE, valid_days=VALID_DAYS, **options)
    return materialize(frame, "model-frame"), inputs


@query("i1_stream_scoring", f"{KEY} pred_qty:f error:s", "SELECT * FROM scored")
def _(s):
    folder, out = fresh_path(s.spark, "requests"), fresh_path(s.spark, "answers")
    s.requests.write.parquet(folder)
    registry = materialize(s.point_registry, "registry")
    state = fresh_path(s.spark, "stream-state")
    for _ in range(2):
        # the second start finds nothing new and must add nothing
        requests = stream.read_requests(s.spark, folder)
        stream.score_stream(requests, registry, out, state).awaitTermination()
    return s.spark.read.parquet(out)


@query(
    "i1_stream_batches",
    f"{KEY} pred_qty:f error:s registry_version:i",
    """
SELECT date, store_nbr, family, error, pred_qty + CASE WHEN store_nbr % 2 = 0 THEN 1000 ELSE 0 END AS pred_qty,
       CASE WHEN store_nbr % 2 = 0 THEN 1 ELSE 2 END AS registry_version
FROM scored""",
)
def _(s):
    folder, out, state = (fresh_path(s.spark, n) for n in ("requests", "answers", "stream-state"))
    root = fresh_path(s.spark, "registries")
    registry = materialize(s.point_registry, "registry")
    early = registry.withColumn("intercept", F.col("intercept") + 1000)
    # the models are retrained between two starts of the stream
    for models_, part in ((early, 0), (registry, 1)):
        stream.publish_registry(models_, root)
        s.requests.filter(F.col("store_nbr") % 2 == part).write.mode("append").parquet(folder)
        requests = stream.read_requests(s.spark, folder)
        stream.score_batches(requests, root, out, state).awaitTermination()
    return s.spark.read.parquet(out)


@query("j1_metrics_per_pair", METRIC_COLS, "SELECT * FROM metrics")
def _(s):
    return s.metrics


@query(
    "j2_batch_predict",
    f"{KEY} y_pred:f",
    """
SELECT d.date, d.store_nbr, d.family, r.intercept + r.slope * d.trend AS y_pred
FROM daily d JOIN point_registry r USING (store_nbr, family)""",
)
def _(s):
    params = s.point_registry.select(*PAIR, "weights", "intercept")
    return models.score_linear(s.daily, params, ["trend"])


@query(
    "k1_baseline_models",
    f"{PAIR_COLS} NAIVE_LAG7_MAE:f NAIVE_LAG7_MAPE_%:f NAIVE_MA7_MAE:f NAIVE_MA7_MAPE_%:f",
    f"""
SELECT store_nbr, family, {mae_mape("sales", "naive_lag7", "NAIVE_LAG7_")},
       {mae_mape("sales", "naive_ma7", "NAIVE_MA7_")}
FROM split WHERE is_valid GROUP BY 1, 2""",
)
def _(s):
    held = s.split.filter("is_valid")
    return E.error_metrics(held, {"NAIVE_LAG7_": "naive_lag7", "NAIVE_MA7_": "naive_ma7"})


@query(
    "k2_trend_models",
    f"{PAIR_COLS} slope:f intercept:f",
    "SELECT * FROM fit",
)
def _(s):
    return s.fit


@query("k2_trend_predictions", f"{KEY} sales:f y_pred:f", "SELECT * FROM held")
def _(s):
    return s.held


@query("k3_ridge_metrics", f"{PAIR_COLS} MAE:f MAPE_%:f")
def _(s):
    return models.ridge_metrics(written_features(s), RIDGE, VALID_DAYS)


@query(
    "k3_ridge_sums",
    f"{PAIR_COLS} n:l sum_x:f sum_y:f xx:f xy:f yy:f",
    """
SELECT store_nbr, family, COUNT(*) AS n, SUM(onpromotion) AS sum_x, SUM(sales) AS sum_y,
       SUM(onpromotion * onpromotion) AS xx, SUM(onpromotion * sales) AS xy,
       SUM(sales * sales) AS yy
FROM split WHERE NOT is_valid GROUP BY 1, 2""",
)
def _(s):
    sums = models.ridge_sums(s.split, ["onpromotion"], ~F.col("is_valid"))
    return sums.select(
        *PAIR,
        "n",
        F.element_at("s", 1).alias("sum_x"),
        F.element_at("s", 2).alias("sum_y"),
        *[F.element_at("g", i + 1).alias(c) for i, c in enumerate(["xx", "xy", "yy"])],
    )


TWO = ["onpromotion", "trend"]
TWO_GROUPS = {"promo": ["onpromotion"], "trend": ["trend"]}


@query(
    "k3_ridge_two_inputs",
    f"{PAIR_COLS} MAE:f MAPE_%:f",
    f"""
SELECT store_nbr, family, {mae_mape("sales", "p")} FROM ridge_held WHERE setting = 'full'
GROUP BY 1, 2""",
)
def _(s):
    return models.ridge_metrics(s.daily, TWO, VALID_DAYS)


@query(
    "k8_ridge_folds",
    f"{PAIR_COLS} fold:i MAE:f MAPE_%:f n_fold:l",
    f"""
SELECT store_nbr, family, fold, {mae_mape("sales", "p")}, COUNT(*) AS n_fold
FROM (SELECT d.*, r.w1 * d.onpromotion + r.w2 * d.trend + r.b AS p
      FROM fold_rows d JOIN ridge_folds r USING (store_nbr, family, fold)
      WHERE d.in_fold AND r.setting = 'full')
GROUP BY 1, 2, 3
HAVING COUNT(*) >= GREATEST(7, CAST(FLOOR(0.05 * MAX(n_rows)) AS BIGINT))""",
)
def _(s):
    return models.ridge_cross_validation(s.daily, TWO, FOLDS, VALID_DAYS, STEP_DAYS)


@query(
    "k10_ablation_two_inputs",
    f"{PAIR_COLS} setting:s MAE:f MAPE_%:f n_val:l",
    f"""
SELECT store_nbr, family, setting, {mae_mape("sales", "p")}, COUNT(*) AS n_val
FROM ridge_held GROUP BY 1, 2, 3""",
)
def _(s):
    return models.ablation(s.daily, TWO, VALID_DAYS, groups=TWO_GROUPS)


@query(
    "k11_ridge_two_inputs",
    f"{PAIR_COLS} feature:s mean_abs_effect:f",
    """
SELECT store_nbr, family, feature, AVG(ABS(effect)) AS mean_abs_effect
FROM (SELECT d.store_nbr, d.family, UNNEST(['onpromotion', 'trend']) AS feature,
             UNNEST([r.w1 * (d.onpromotion - m.m1), r.w2 * (d.trend - m.m2)]) AS effect
      FROM daily d JOIN ridge_whole r USING (store_nbr, family)
      JOIN (SELECT store_nbr, family, AVG(onpromotion) AS m1, AVG(trend) AS m2 FROM daily
            GROUP BY 1, 2) m USING (store_nbr, family)
      WHERE r.setting = 'full')
GROUP BY 1, 2, 3""",
)
def _(s):
    params = models.fit_ridge(s.daily, TWO, F.lit(True))
    return models.linear_attribution(s.daily, params, TWO, s.daily)


@query("k4_boosted_trees", f"{PAIR_COLS} MAE:f MAPE_%:f")
def _(s):
    frame, inputs = written_frame(s, log1p=True, mape_weighting=True)
    trees = models.boosted_trees(inputs, **BOOSTING)
    model = models.fit_global(frame, trees, uses_holdout=True)
    held = models.predict_global(model, frame.filter("is_valid"), log1p=True)
    return E.error_metrics(held, {"": "y_pred"})


@query("k5_random_forest", f"{PAIR_COLS} MAE:f MAPE_%:f")
def _(s):
    # the sparse panel has few rows in its holdout days: the gate of the default holdout
    frame, inputs = written_frame(s, scope="pair", gate=forest_gate())
    model = models.fit_global(frame, models.random_forest(inputs, **FOREST))
    return E.error_metrics(models.predict_global(model, frame.filter("is_valid")), {"": "y_pred"})


@query("k6_tweedie", f"{PAIR_COLS} MAE:f MAPE_%:f")
def _(s):
    frame, inputs = written_frame(s)
    model = models.fit_global(frame, models.generalized_linear(inputs, "tweedie", 1.2))
    return E.error_metrics(models.predict_global(model, frame.filter("is_valid")), {"": "y_pred"})


@query("k6_poisson", f"{PAIR_COLS} MAE:f MAPE_%:f")
def _(s):
    frame, inputs = written_frame(s)
    model = models.fit_global(frame, models.generalized_linear(inputs, "poisson"))
    return E.error_metrics(models.predict_global(model, frame.filter("is_valid")), {"": "y_pred"})


def _by_promotion(s):
    """One binary input: a single split, or a saturated regression, predicts group means."""
    rows = s.daily.withColumn("promo", (F.col("onpromotion") > 0).cast("double"))
    frame, inputs = models.model_frame(rows, ["promo"], (), VALID_DAYS)
    return materialize(frame, "promo-frame"), inputs


_GROUP_MEANS = f"SELECT store_nbr, family, {mae_mape('sales', 'p')} FROM promo_held GROUP BY 1, 2"


@query("k4_one_round", f"{PAIR_COLS} MAE:f MAPE_%:f", _GROUP_MEANS)
def _(s):
    frame, inputs = _by_promotion(s)
    trees = models.boosted_trees(inputs, max_iter=1, depth=1, subsample=1.0)
    model = models.fit_global(frame, trees, uses_holdout=True)
    return E.error_metrics(models.predict_global(model, frame.filter("is_valid")), {"": "y_pred"})


@query("k5_one_split", f"{PAIR_COLS} MAE:f MAPE_%:f", _GROUP_MEANS)
def _(s):
    frame, inputs = _by_promotion(s)
    tree = models.random_forest(inputs, trees=1, depth=1, bootstrap=False)
    model = models.fit_global(frame, tree)
    return E.error_metrics(models.predict_global(model, frame.filter("is_valid")), {"": "y_pred"})


@query("k6_saturated", f"{PAIR_COLS} MAE:f MAPE_%:f", _GROUP_MEANS)
def _(s):
    frame, inputs = _by_promotion(s)
    model = models.fit_global(frame, models.generalized_linear(inputs, "poisson", reg=0.0))
    return E.error_metrics(models.predict_global(model, frame.filter("is_valid")), {"": "y_pred"})


@query(
    "k9_search_one_round",
    "trial:i best_iteration:i MAE:f",
    "SELECT t AS trial, 1 AS best_iteration, mae AS \"MAE\" FROM (SELECT AVG(ABS(sales - p)) AS mae"
    " FROM promo_held), (SELECT UNNEST([0, 1]) AS t)",
)
def _(s):
    frame, inputs = _by_promotion(s)
    setting = {"max_iter": 1, "step": 0.1, "depth": 1, "subsample": 1.0}
    return models.search(frame, inputs, [setting, {**setting, "depth": 2}])


@query(
    "d5_global_summary",
    "model:s MAE:f MAPE:f size_hint:s",
    f"""
SELECT 'one split' AS model, AVG(ABS(sales - p)) AS "MAE", AVG({ape("sales", "p")}) * 100 AS "MAPE",
       'one tree' AS size_hint FROM promo_held
UNION ALL SELECT 'trend per pair', AVG("MAE"), AVG("MAPE_%"), 'row per pair' FROM metrics""",
)
def _(s):
    frame, inputs = _by_promotion(s)
    model = models.fit_global(frame, models.random_forest(inputs, trees=1, depth=1, bootstrap=False))
    held = models.predict_global(model, frame.filter("is_valid"))
    # a global model is judged over all of its holdout rows at once
    overall = E.error_metrics(held, {"": "y_pred"}, keys=())
    runs = {"one split": (overall, "one tree"), "trend per pair": (s.metrics, "row per pair")}
    return compare.model_summary(runs)


@query("k7_residual_quantiles", f"{PAIR_COLS} quantile:f shift:f", "SELECT * FROM residual_shift")
def _(s):
    return models.residual_quantiles(s.split, s.fit, ~F.col("is_valid"))


@query("k7_quantile_models", f"{PAIR_COLS} quantile:f n:l coverage:f loss:f")
def _(s):
    rows = materialize(add_holdout(written_features(s), VALID_DAYS), "quantile-split")
    params = quantiles.fit_quantiles(rows, RIDGE, ~F.col("is_valid"))
    held = quantiles.score_quantile_models(rows.filter("is_valid"), params, RIDGE)
    return quantiles.quantile_coverage(held)


@query(
    "k7_quantiles_by_promotion",
    f"{PAIR_COLS} quantile:f n:l loss:f",
    """
SELECT store_nbr, family, quantile, COUNT(*) AS n,
       AVG(GREATEST(quantile * (sales - c), (quantile - 1) * (sales - c))) AS loss
FROM (SELECT *, MAX(CASE WHEN rn = GREATEST(1, CEIL(quantile * n_group)) THEN sales END)
               OVER (PARTITION BY store_nbr, family, promo, quantile) AS c
      FROM (SELECT *, onpromotion > 0 AS promo,
                   ROW_NUMBER() OVER (PARTITION BY store_nbr, family, onpromotion > 0 ORDER BY sales) AS rn,
                   COUNT(*) OVER (PARTITION BY store_nbr, family, onpromotion > 0) AS n_group
            FROM daily), (SELECT UNNEST([0.5::DOUBLE, 0.9::DOUBLE]) AS quantile))
GROUP BY 1, 2, 3""",
)
def _(s):
    # one binary input: the least pinball loss is that of the quantile of each group
    rows = s.daily.withColumn("promo", (F.col("onpromotion") > 0).cast("double"))
    return quantiles.fit_quantiles(rows, ["promo"], F.lit(True))


@query(
    "k8_trend_folds",
    f"{PAIR_COLS} fold:i MAE:f MAPE_%:f n_fold:l",
    "SELECT * FROM fold_metrics",
)
def _(s):
    return models.trend_cross_validation(s.daily, FOLDS, VALID_DAYS, STEP_DAYS)


@query(
    "k8_trend_folds_past_only",
    f"{PAIR_COLS} fold:i MAE:f MAPE_%:f n_fold:l",
    f"""
SELECT store_nbr, family, fold, {mae_mape("sales", "p")}, COUNT(*) AS n_fold
FROM (SELECT r.*, f.intercept + f.slope * r.trend AS p
      FROM fold_rows r JOIN (
        SELECT store_nbr, family, fold,
               REGR_SLOPE(CASE WHEN in_past THEN sales END, CASE WHEN in_past THEN trend END) AS slope,
               REGR_INTERCEPT(CASE WHEN in_past THEN sales END, CASE WHEN in_past THEN trend END)
                 AS intercept
        FROM fold_rows GROUP BY 1, 2, 3) f USING (store_nbr, family, fold)
      WHERE r.in_fold)
GROUP BY 1, 2, 3
HAVING COUNT(*) >= GREATEST(7, CAST(FLOOR(0.05 * MAX(n_rows)) AS BIGINT))""",
)
def _(s):
    return models.trend_cross_validation(s.daily, FOLDS, VALID_DAYS, STEP_DAYS, "past_only")


@query(
    "k8_baseline_folds",
    f"{PAIR_COLS} fold:i LAG7_MAE:f MA7_MAE:f n_fold:l",
    """
SELECT r.store_nbr, r.family, r.fold, AVG(ABS(r.sales - s.naive_lag7)) AS "LAG7_MAE",
       AVG(ABS(r.sales - s.naive_ma7)) AS "MA7_MAE", COUNT(*) AS n_fold
FROM fold_rows r JOIN split s USING (store_nbr, family, date) WHERE r.in_fold
GROUP BY 1, 2, 3
HAVING COUNT(*) >= GREATEST(7, CAST(FLOOR(0.05 * MAX(r.n_rows)) AS BIGINT))""",
)
def _(s):
    return models.baseline_cross_validation(s.daily, FOLDS, VALID_DAYS, STEP_DAYS)


@query(
    "k8_global_folds",
    f"{PAIR_COLS} fold:i MAE:f MAPE_%:f n_fold:l",
    f"""
SELECT store_nbr, family, fold, {mae_mape("sales", "p")}, COUNT(*) AS n_fold
FROM (SELECT r.*, m.p
      FROM (SELECT *, onpromotion > 0 AS promo FROM fold_rows WHERE in_fold) r
      JOIN (SELECT fold, onpromotion > 0 AS promo, AVG(sales) AS p FROM fold_rows WHERE NOT in_fold
            GROUP BY 1, 2) m USING (fold, promo))
GROUP BY 1, 2, 3
HAVING COUNT(*) >= GREATEST(7, CAST(FLOOR(0.05 * MAX(n_rows)) AS BIGINT))""",
)
def _(s):
    frame, inputs = _by_promotion(s)

    def one_split():
        return models.random_forest(inputs, trees=1, depth=1, bootstrap=False)

    return validation.global_cross_validation(frame, one_split, FOLDS, VALID_DAYS, STEP_DAYS, scope="pair")


@query("k8_tweedie_folds", f"{PAIR_COLS} fold:i MAE:f MAPE_%:f n_fold:l")
def _(s):
    frame, inputs = written_frame(s)
    return validation.global_cross_validation(
        frame, lambda: models.generalized_linear(inputs, "tweedie", 1.2), FOLDS, VALID_DAYS, STEP_DAYS, "past_only"
    )


@query("k9_search", "trial:i rung:i rounds:i best_iteration:i MAE:f finished:b")
def _(s):
    frame, inputs = written_frame(s)
    return validation.successive_halving(frame, inputs, validation.draw_settings(SEARCH_TRIALS))


@query(
    "k9_halving_one_round",
    "trial:i rung:i rounds:i best_iteration:i MAE:f finished:b",
    """
SELECT t AS trial, 0 AS rung, 1 AS rounds, 1 AS best_iteration, mae AS "MAE", TRUE AS finished
FROM (SELECT AVG(ABS(sales - p)) AS mae FROM promo_held), (SELECT UNNEST([0, 1, 2]) AS t)""",
)
def _(s):
    frame, inputs = _by_promotion(s)
    setting = validation.draw_settings(1)[0] | {"n_estimators": 1, "subsample": 1.0, "colsample_bytree": 1.0}
    setting |= {"min_child_samples": 1, "lambda_l1": 0.0, "lambda_l2": 0.0}
    leaves = [{**setting, "num_leaves": n} for n in (2, 4, 8)]
    return validation.successive_halving(frame, inputs, leaves)


@query(
    "k11_tree_effects_one_split",
    f"{PAIR_COLS} feature:s mean_abs_effect:f",
    """
SELECT store_nbr, family, 'promo' AS feature, AVG(ABS(p - base)) AS mean_abs_effect
FROM promo_held, (SELECT AVG(sales) AS base FROM promo_rows WHERE NOT is_valid) GROUP BY 1, 2""",
)
def _(s):
    frame, inputs = _by_promotion(s)
    model = models.fit_global(frame, models.random_forest(inputs, trees=1, depth=1, bootstrap=False))
    parts = attribution.contributions(frame.filter("is_valid"), model.stages[-1], inputs, [*PAIR, "date"])
    return attribution.mean_effects(parts, inputs, PAIR)


@query("k11_forest_attribution", "feature:s mean_abs_effect:f")
def _(s):
    frame, inputs = written_frame(s)
    model = models.fit_global(frame, models.random_forest(inputs, **FOREST))
    tail = W.last_rows(frame, 30)
    return attribution.mean_effects(
        attribution.contributions(tail, model.stages[-1], inputs, [*PAIR, "date"]), inputs
    )


@query("k10_ablation", f"{PAIR_COLS} setting:s MAE:f MAPE_%:f n_val:l")
def _(s):
    return models.ablation(written_features(s), RIDGE, VALID_DAYS)


@query(
    "k11_trend_attribution",
    f"{PAIR_COLS} feature:s mean_abs_effect:f",
    """
SELECT q.store_nbr, q.family, 'trend' AS feature, AVG(ABS(f.slope * (q.trend - m.mu)))
       AS mean_abs_effect
FROM tail_rows q JOIN fit f USING (store_nbr, family)
JOIN (SELECT store_nbr, family, AVG(trend) AS mu FROM daily GROUP BY 1, 2) m
  USING (store_nbr, family)
GROUP BY 1, 2""",
)
def _(s):
    return models.trend_attribution(s.daily, s.fit, W.last_rows(s.daily, 30))


@query("k11_ridge_attribution", f"{PAIR_COLS} feature:s mean_abs_effect:f")
def _(s):
    rows = written_features(s)
    params = models.fit_ridge(rows, RIDGE, F.lit(True))
    return models.linear_attribution(rows, params, RIDGE, W.last_rows(rows, 200))


@query(
    "k12_batch_scoring",
    f"{KEY} pred_qty:f used_features:s error:s",
    """
SELECT date, store_nbr, family, pred_qty, error, CASE WHEN error IS NULL THEN 'trend' END
       AS used_features FROM scored""",
)
def _(s):
    scored = scoring.score_requests(s.requests, s.point_registry)
    return scored.withColumn("used_features", F.array_join("used_features", ","))


@query(
    "k13_quantile_scoring",
    f"{KEY} q:f pred:f error:s",
    """
SELECT q.date, q.store_nbr, q.family, r.quantile AS q, r.intercept + r.slope * q.trend AS pred,
       CASE WHEN r.slope IS NULL THEN 'Model not found' END AS error
FROM requests q LEFT JOIN quantile_registry r USING (store_nbr, family)""",
)
def _(s):
    # 0.25 has no model and is left out of the answer
    scored = scoring.score_quantiles(s.requests, s.registry, [0.25, 0.5, 0.9])
    return scored.select(
        *PAIR, "date", F.explode_outer("quantiles").alias("q", "pred"), "error"
    ).withColumn("q", F.col("q").cast("double"))


@query(
    "k14_registry_listing",
    f"{PAIR_COLS} model_key:s n_models:l quantiles:s",
    """
SELECT store_nbr, family, CAST(store_nbr AS VARCHAR) || '__' || REPLACE(family, ' ', '_') AS model_key,
       COUNT(*) + 1 AS n_models, STRING_AGG(CAST(quantile AS VARCHAR), ',' ORDER BY quantile) AS quantiles
FROM quantile_registry GROUP BY 1, 2""",
)
def _(s):
    listing = scoring.registry_listing(s.registry)
    text = F.transform("quantiles", lambda q: q.cast("string"))
    return listing.withColumn("quantiles", F.array_join(text, ","))


_COMPARE = f"""
SELECT a.store_nbr, a.family, t.tail_sum, t."A_MAE", t."A_MAPE_%", t."B_MAE", t."B_MAPE_%",
       CASE WHEN r.slope IS NULL THEN 'no A model' WHEN t.n IS NULL THEN 'empty tail'
            WHEN t.n_a = 0 THEN 'no A prediction' WHEN t.n_b = 0 THEN 'no B prediction'
            WHEN t.tail_sum < 600 THEN 'tail_sum<600' END AS reason
FROM (SELECT DISTINCT store_nbr, family FROM panel) a
LEFT JOIN point_registry r USING (store_nbr, family)
LEFT JOIN (SELECT store_nbr, family, COUNT(*) AS n, COUNT(y_pred) AS n_a, COUNT(naive_ma7) AS n_b,
                  SUM(sales) AS tail_sum, {mae_mape("sales", "y_pred", "A_")},
                  {mae_mape("sales", "naive_ma7", "B_")}
           FROM (SELECT s.*, m.intercept + m.slope * s.trend AS y_pred,
                        ROW_NUMBER() OVER (PARTITION BY s.store_nbr, s.family
                                           ORDER BY s.date DESC) AS rn
                 FROM split s LEFT JOIN point_registry m USING (store_nbr, family))
           WHERE rn <= 28 GROUP BY 1, 2) t USING (store_nbr, family)"""


def _compared(s):
    """Trend against moving average on the last 28 rows of every pair."""
    params = models.fit_gated_trend(s.split).filter("slope IS NOT NULL")
    tail = W.last_rows(s.split, 28).join(params, PAIR, "left")
    tail = tail.withColumn("y_pred", models.trend_prediction())
    return compare.compare_on_tail(s.stored_panel, params, tail, "y_pred", "naive_ma7", 600)


@query(
    "k15_compare_models",
    f"{PAIR_COLS} tail_sum:f A_MAE:f A_MAPE:f B_MAE:f B_MAPE:f GAIN_B_vs_A_MAE:f GAIN_B_vs_A_MAPE:f"
    " reason:s",
    f"""
SELECT store_nbr, family, tail_sum, "A_MAE", "A_MAPE_%" AS "A_MAPE", "B_MAE", "B_MAPE_%" AS "B_MAPE",
       "A_MAE" - "B_MAE" AS "GAIN_B_vs_A_MAE", "A_MAPE_%" - "B_MAPE_%" AS "GAIN_B_vs_A_MAPE", reason
FROM ({_COMPARE})""",
)
def _(s):
    return _compared(s)


@query(
    "k15_compare_two_models",
    f"{PAIR_COLS} tail_sum:f trend_MAE:f trend_MAPE:f ridge_MAE:f ridge_MAPE:f GAIN_ridge_vs_trend_MAE:f reason:s",
    f"""
SELECT store_nbr, family, tail_sum, "trend_MAE", "trend_MAPE_%" AS "trend_MAPE", "ridge_MAE",
       "ridge_MAPE_%" AS "ridge_MAPE", "trend_MAE" - "ridge_MAE" AS "GAIN_ridge_vs_trend_MAE",
       CASE WHEN r.slope IS NULL THEN 'no trend model' WHEN t.n IS NULL THEN 'empty tail'
            WHEN t.n_a = 0 THEN 'no trend prediction' WHEN t.n_b = 0 THEN 'no ridge prediction'
            WHEN t.tail_sum < 600 THEN 'tail_sum<600' END AS reason
FROM (SELECT DISTINCT store_nbr, family FROM panel)
LEFT JOIN point_registry r USING (store_nbr, family)
LEFT JOIN (SELECT store_nbr, family, COUNT(*) AS n, COUNT(a) AS n_a, COUNT(b) AS n_b, SUM(sales) AS tail_sum,
                  {mae_mape("sales", "a", "trend_")}, {mae_mape("sales", "b", "ridge_")}
           FROM (SELECT s.*, m.intercept + m.slope * s.trend AS a,
                        g.w1 * s.onpromotion + g.w2 * s.trend + g.b AS b,
                        ROW_NUMBER() OVER (PARTITION BY s.store_nbr, s.family ORDER BY s.date DESC) AS rn
                 FROM split s LEFT JOIN point_registry m USING (store_nbr, family)
                 LEFT JOIN (SELECT * FROM ridge_split WHERE setting = 'full') g USING (store_nbr, family))
           WHERE rn <= 28 GROUP BY 1, 2) t USING (store_nbr, family)""",
)
def _(s):
    train = ~F.col("is_valid")
    trend = models.fit_gated_trend(s.split).filter("slope IS NOT NULL")
    tail = W.last_rows(s.split, 28).join(trend, PAIR, "left").withColumn("trend_pred", models.trend_prediction())
    tail = tail.drop("slope", "intercept")
    scored = models.score_linear(tail, models.fit_ridge(s.split, TWO, train), TWO, "ridge_pred")
    return compare.compare_on_tail(
        s.stored_panel, trend, scored, "trend_pred", "ridge_pred", 600, names=("trend", "ridge")
    )


@query(
    "k15_skipped_pairs",
    f"{PAIR_COLS} reason:s",
    f"SELECT store_nbr, family, reason FROM ({_COMPARE}) WHERE reason IS NOT NULL",
)
def _(s):
    return compare.skipped(_compared(s))


@query(
    "k16_backtest",
    f"{KEY} sales:f pred_qty:f p50:f p90:f",
    """
SELECT q.date, q.store_nbr, q.family, q.sales, q.pred_qty,
       q.pred_qty + a.shift AS p50, q.pred_qty + b.shift AS p90
FROM (SELECT r.*, p.intercept + p.slope * r.trend AS pred_qty
      FROM tail_rows r JOIN point_registry p USING (store_nbr, family)) q
JOIN residual_shift a ON q.store_nbr = a.store_nbr AND q.family = a.family AND a.quantile = 0.5
JOIN residual_shift b ON q.store_nbr = b.store_nbr AND q.family = b.family AND b.quantile = 0.9""",
)
def _(s):
    return scoring.backtest(W.last_rows(s.daily, 30), s.registry, ["trend"])


