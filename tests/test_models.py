import datetime as dt
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.split import add_holdout
from shelfcast.plans import models as M
from shelfcast.plans import scoring
from tests.helpers import day


def trending(spark, days=60, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for store, family, slope in [(1, "a", 0.5), (1, "b", -0.2), (2, "a", 0.0)]:
        for t in range(days):
            promo = float(t % 5 == 0)
            sales = 20 + slope * t + 4 * promo + float(rng.normal(0, 1))
            rows.append((day(t), store, family, sales, promo, t))
    return spark.createDataFrame(
        rows,
        "date date, store_nbr int, family string, sales double, onpromotion double, trend int",
    )


@pytest.fixture(scope="module")
def frame(spark):
    df = trending(spark)
    df.cache().count()
    return df


def arrays(frame, store, family, valid):
    pdf = frame.toPandas()
    pdf = pdf[(pdf.store_nbr == store) & (pdf.family == family)].sort_values("date")
    return pdf.iloc[:-valid], pdf.iloc[-valid:]


def test_trend_equals_least_squares(frame):
    split = add_holdout(frame, 10)
    got = M.fit_trend(split, ~F.col("is_valid")).filter("store_nbr = 1 and family = 'a'").first()
    train, _ = arrays(frame, 1, "a", 10)
    slope, intercept = np.polyfit(train.trend, train.sales, 1)
    assert (got.slope, got.intercept) == (pytest.approx(slope), pytest.approx(intercept))


def test_metric_table(frame):
    got = {(r.store_nbr, r.family): r for r in M.metrics_per_pair(frame, 10, 2, 10).collect()}
    assert len(got) == 3
    train, held = arrays(frame, 1, "b", 10)
    p = np.polyval(np.polyfit(train.trend, train.sales, 1), held.trend)
    row = got[(1, "b")]
    assert row.MAE == pytest.approx(np.mean(np.abs(held.sales - p)))
    assert row["MAPE_%"] == pytest.approx(np.mean(np.abs((held.sales - p) / held.sales)) * 100)
    assert row.MAE_GAIN_vs_LAG7 == pytest.approx(row.NAIVE_LAG7_MAE - row.MAE)
    assert row.CV_MAE is not None


def test_pairs_with_a_short_holdout_are_left_out(spark):
    rows = [(day(i), 1, "x", 1.0 + i, i) for i in (0, 1, 2, 50, 60)]
    df = spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double, trend int")
    assert M.holdout_predictions(df, 28).isEmpty()


def test_fold_training_rows(frame):
    outside = M.trend_cross_validation(frame, 2, 10, 10).filter("store_nbr = 1 and family = 'a'")
    pdf = frame.toPandas()
    pdf = pdf[(pdf.store_nbr == 1) & (pdf.family == "a")].sort_values("date")
    inside = (pdf.trend >= 40) & (pdf.trend <= 49)
    fit = np.polyfit(pdf.trend[~inside], pdf.sales[~inside], 1)
    want = np.mean(np.abs(pdf.sales[inside] - np.polyval(fit, pdf.trend[inside])))
    assert outside.filter("fold = 0").first().MAE == pytest.approx(want)
    past = M.trend_cross_validation(frame, 2, 10, 10, "past_only").filter(
        "store_nbr = 1 and family = 'a' and fold = 0"
    )
    fit = np.polyfit(pdf.trend[pdf.trend < 40], pdf.sales[pdf.trend < 40], 1)
    want = np.mean(np.abs(pdf.sales[inside] - np.polyval(fit, pdf.trend[inside])))
    assert past.first().MAE == pytest.approx(want)


def test_residual_quantiles(frame):
    split = add_holdout(frame, 10)
    train_rows = ~F.col("is_valid")
    shifts = M.residual_quantiles(split, M.fit_trend(split, train_rows), train_rows, (0.5, 0.9))
    got = {r.quantile: r["shift"] for r in shifts.filter("store_nbr = 2").collect()}
    train, _ = arrays(frame, 2, "a", 10)
    resid = train.sales - np.polyval(np.polyfit(train.trend, train.sales, 1), train.trend)
    for q in (0.5, 0.9):
        assert got[q] == pytest.approx(np.quantile(resid, q))


FEATURES = ["trend", "onpromotion"]


def ridge_twin(train, alpha):
    x = train[FEATURES].to_numpy(float)
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / sd
    y = train.sales.to_numpy()
    beta = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean()))
    return beta / sd, y.mean() - (beta / sd) @ mu


@pytest.mark.parametrize("alpha", [0.0, 5.0])
def test_ridge_equals_direct_solution(frame, alpha):
    split = add_holdout(frame, 10)
    params = M.fit_ridge(split, FEATURES, ~F.col("is_valid"), alpha)
    got = params.filter("store_nbr = 1 and family = 'a'").first()
    train, _ = arrays(frame, 1, "a", 10)
    weights, intercept = ridge_twin(train, alpha)
    assert got.weights == pytest.approx(list(weights))
    assert got.intercept == pytest.approx(intercept)


def test_ridge_ignores_columns_that_do_not_vary(frame):
    df = frame.withColumn("flat", F.lit(3.0))
    params = M.fit_ridge(df, ["trend", "flat"], F.lit(True), 0.0).first()
    assert params.weights[1] == 0.0
    assert M.ridge_metrics(df, ["trend", "flat"], 10).count() == 3


@pytest.mark.parametrize("shift", [0.0, 1e8])
def test_ridge_keeps_the_digits_of_large_columns(spark, shift):
    """A column of mean 1e8 and spread 1 gets the weights of the same column about 0."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, 400)
    y = 3 * x + rng.normal(0, 0.1, 400)
    rows = [(day(i), 1, "a", float(y[i]), float(x[i] + shift)) for i in range(400)]
    df = spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double, x double")
    fitted = M.fit_ridge(df, ["x"], F.lit(True), 0.0).first()
    slope = np.polyfit(x, y, 1)[0]
    assert fitted["weights"][0] == pytest.approx(slope, rel=1e-6)
    folds = M.ridge_cross_validation(df, ["x"], 3, 28, 28, 0.0).collect()
    assert len(folds) == 3
    assert all(r["MAE"] < 0.12 for r in folds)


def test_ablation_settings(frame):
    groups = {"promo": ["onpromotion"], "time": ["trend"], "none": ["not_there"]}
    got = M.ablation(frame, FEATURES, 10, groups=groups).collect()
    by = {(r.store_nbr, r.family, r.setting): r for r in got}
    assert {r.setting for r in got} == {"full", "w/o promo", "w/o time"}
    assert by[(1, "a", "full")].n_val == 10
    assert by[(1, "a", "full")].MAE < by[(1, "a", "w/o time")].MAE
    full = M.ridge_metrics(frame, FEATURES, 10).filter("store_nbr = 1 and family = 'a'").first()
    assert by[(1, "a", "full")].MAE == pytest.approx(full.MAE)


def test_linear_attribution(frame):
    params = M.fit_ridge(frame, FEATURES, F.lit(True), 0.0)
    got = M.linear_attribution(frame, params, FEATURES, frame)
    rows = {r.feature: r.mean_abs_effect for r in got.filter("store_nbr = 1 and family = 'a'").collect()}
    pdf = frame.toPandas()
    pdf = pdf[(pdf.store_nbr == 1) & (pdf.family == "a")]
    w = params.filter("store_nbr = 1 and family = 'a'").first().weights
    assert rows["trend"] == pytest.approx(np.mean(np.abs(w[0] * (pdf.trend - pdf.trend.mean()))))
    top = M.top_features(got.filter("store_nbr = 1 and family = 'a'"), 1, "mean_abs_effect").first()
    assert top.feature == "trend"


def test_global_models(spark, frame):
    table, inputs = M.model_frame(frame, FEATURES, valid_days=10, log1p=True, mape_weighting=True)
    table.cache()
    trees = M.fit_global(table, M.boosted_trees(inputs, max_iter=5, depth=3), uses_holdout=True)
    held = M.predict_global(trees, table.filter("is_valid"), log1p=True).toPandas()
    assert np.abs(held.sales - held.y_pred).mean() < 20
    names = M.importances(trees, inputs, spark)
    assert names.count() == len(inputs) and M.top_features(names, 2).count() == 2
    plain, inputs = M.model_frame(frame, FEATURES, valid_days=10)
    forest = M.fit_global(plain, M.random_forest(inputs, trees=5, depth=4))
    assert M.predict_global(forest, plain).count() == frame.count()
    for family in ("tweedie", "poisson"):
        glm = M.fit_global(plain, M.generalized_linear(inputs, family))
        assert M.predict_global(glm, plain).agg(F.min("y_pred")).first()[0] > 0


def test_search_draws_rounds_from_the_full_range():
    rounds = [c["max_iter"] for c in M.parameter_candidates(200)]
    assert 300 <= min(rounds) < 400 and 2900 < max(rounds) <= 3000
    assert {c["max_iter"] for c in M.parameter_candidates(50, rounds=(5, 6))} == {5, 6}


def test_search_ranks_seeded_candidates(frame):
    table, inputs = M.model_frame(frame, FEATURES, valid_days=10)
    table.cache()
    assert M.parameter_candidates(4, 1) == M.parameter_candidates(4, 1)
    trials = [{"max_iter": 2, "step": 0.1, "depth": 2, "subsample": 0.9}, {"max_iter": 4, "depth": 3}]
    got = M.search(table, inputs, trials).collect()
    assert [r.MAE for r in got] == sorted(r.MAE for r in got) and len(got) == 2


# ------------------------------------------------------------------ scoring


@pytest.fixture(scope="module")
def registry(frame):
    all_rows = F.lit(True)
    params = M.fit_trend(frame, all_rows)
    shifts = M.residual_quantiles(frame, params, all_rows).filter("store_nbr = 1")
    return scoring.registry_from_trend(params, shifts)


@pytest.fixture(scope="module")
def requests(spark):
    rows = [
        (1, "a", dt.date(2024, 5, 1), {"trend": 100.0}),
        (2, "a", dt.date(2024, 5, 1), {"other": 1.0}),
        (9, "z", dt.date(2024, 5, 1), {"trend": 1.0}),
    ]
    return spark.createDataFrame(
        rows, "store_nbr int, family string, date date, request map<string,double>"
    )


def test_batch_scoring(requests, registry):
    got = {r.store_nbr: r for r in scoring.score_requests(requests, registry).collect()}
    params = {
        r.store_nbr: r
        for r in registry.filter("quantile is null and family = 'a'").collect()
    }
    assert got[1].pred_qty == pytest.approx(params[1].intercept + 100 * params[1].weights[0])
    assert got[2].pred_qty == pytest.approx(params[2].intercept)  # absent feature counts as 0
    assert got[1].used_features == ["trend"] and got[1].error is None
    assert got[9].error == scoring.NOT_FOUND and got[9].pred_qty is None


def test_quantile_scoring(requests, registry):
    scored = scoring.score_quantiles(requests, registry, [0.1, 0.5, 0.9])
    got = {r.store_nbr: r for r in scored.collect()}
    assert set(got[1].quantiles) == {"0.5", "0.9"}
    assert got[1].quantiles["0.9"] > got[1].quantiles["0.5"]
    assert got[2].quantiles is None and got[2].error == scoring.NO_QUANTILES
    assert got[9].error == scoring.NOT_FOUND


def test_reorder_points(requests, registry):
    asked = requests.withColumns({"lead_time_days": F.lit(0), "service_level": F.lit(0.9)})
    got = {r.store_nbr: r for r in scoring.reorder_points(asked, registry).collect()}
    assert set(got) == {1, 2}
    q = scoring.score_quantiles(requests, registry).filter("store_nbr = 1").first().quantiles
    one, two = got[1], got[2]
    assert one.quantiles_used and one.daily_mean == pytest.approx(q["0.5"])
    assert one.sigma_daily == pytest.approx((q["0.9"] - q["0.5"]) / 1.2816)
    assert one.lead_time_days == 1 and one.service_level_z == 1.2816
    assert one.reorder_point == pytest.approx(one.daily_mean + one.safety_stock)
    assert not two.quantiles_used and two.sigma_daily == pytest.approx(0.25 * two.daily_mean)
    plain = scoring.reorder_points(requests, registry).first()
    assert plain.lead_time_days == 2 and plain.service_level_z == 1.6449


def test_fallback_to_the_global_model(requests, registry):
    whole = registry.filter("store_nbr = 2 and quantile is null").select(*scoring.PARAM_COLUMNS)
    got = {r.store_nbr: r for r in scoring.score_with_fallback(requests, registry, whole).collect()}
    assert got[1].source == "pair" and got[9].source == "global"
    m = whole.first()
    assert got[9].pred_qty == pytest.approx(m.intercept + m.weights[0])


def test_registry_listing(registry):
    got = {(r.store_nbr, r.family): r for r in scoring.registry_listing(registry).collect()}
    assert got[(1, "a")].quantiles == [0.5, 0.9] and got[(1, "a")].n_models == 3
    assert got[(2, "a")].quantiles == [] and got[(2, "a")].model_key == "2__a"


def test_backtest(frame, registry):
    got = scoring.backtest(frame.filter("store_nbr = 1"), registry, ["trend"]).collect()
    assert len(got) == 120
    assert all(r.p90 >= r.p50 for r in got)


def test_stream_scoring(spark, requests, registry, tmp_path):
    from shelfcast.session import fresh_path, materialize
    from shelfcast.streaming import scoring as stream

    folder, out = fresh_path(spark, "requests"), fresh_path(spark, "answers")
    requests.write.parquet(folder)
    models = materialize(registry, "registry")
    state = str(tmp_path / "state")
    for _ in range(2):
        arriving = stream.read_requests(spark, folder)
        stream.score_stream(arriving, models, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == requests.count()
    got = {r.store_nbr: r.pred_qty for r in spark.read.parquet(out).collect()}
    want = {r.store_nbr: r.pred_qty for r in scoring.score_requests(requests, registry).collect()}
    assert got == want




def test_ridge_runs_without_the_package_on_workers(tmp_path):
    """Workers that cannot import the package still solve the ridge regressions."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "driver.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {repo!r})
from shelfcast.session import build_session
from shelfcast.plans import models
spark = build_session("away", "local[2]", spark__ui__enabled="false")
rows = [(1, "a", float(i), 2.0 * i + 1.0) for i in range(20)]
df = spark.createDataFrame(rows, "store_nbr int, family string, x double, sales double")
from pyspark.sql import functions as F
row = models.fit_ridge(df, ["x"], F.lit(True), alpha=1e-9).first()
assert abs(row.weights[0] - 2) < 1e-6 and abs(row.intercept - 1) < 1e-6
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
