"""Folds and search of global models, and attribution of their trees."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.plans import attribution as A
from shelfcast.plans import models as M
from shelfcast.plans import validation as V
from shelfcast.schemas import PAIR
from shelfcast.session import materialize
from tests.helpers import day


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = [
        (day(i), store, "a", float(10 * store + 5 * (i % 7 == 0) + rng.integers(0, 3)), float(i % 7 == 0), float(rng.random()))
        for store in (1, 2, 3)
        for i in range(90)
    ]
    df = spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double, promo double, noise double")
    built, inputs = M.model_frame(df, ["promo", "noise"], valid_days=14)
    return materialize(built, "frame"), inputs


@pytest.mark.parametrize(("mode", "scope"), [("outside", "global"), ("past_only", "pair")])
def test_folds_train_outside_and_score_inside(frame, mode, scope):
    rows, inputs = frame

    def mean_only():
        return M.random_forest(inputs, trees=1, depth=0, bootstrap=False)

    found = V.global_cross_validation(rows, mean_only, 3, 14, 14, mode, scope)
    got = {(r["store_nbr"], r["fold"]): r["MAE"] for r in found.collect()}
    data = rows.toPandas()
    last = data["date"].max()
    assert len(got) == 9
    for fold in range(3):
        end = last - pd.Timedelta(days=(2 - fold) * 14)
        start = end - pd.Timedelta(days=13)
        inside = (data["date"] >= start) & (data["date"] <= end)
        train = ~inside if mode == "outside" else data["date"] < start
        mean = data.loc[train, "sales"].mean()
        for store in (1, 2, 3):
            own = data[inside & (data["store_nbr"] == store)]
            assert got[(store, fold)] == pytest.approx((own["sales"] - mean).abs().mean())


def test_halving_ranks_like_fitting_everything(frame):
    rows, inputs = frame
    base = V.draw_settings(1)[0] | {"subsample": 1.0, "colsample_bytree": 1.0, "min_child_samples": 1}
    base |= {"lambda_l1": 0.0, "lambda_l2": 0.0, "n_estimators": 12}
    settings = [
        {**base, "learning_rate": rate, "num_leaves": leaves} for rate in (0.001, 0.2) for leaves in (2, 8)
    ]
    halved = V.successive_halving(rows, inputs, settings, first=3, factor=2).collect()
    whole = V.successive_halving(rows, inputs, settings, first=12, factor=2).collect()
    assert halved[0]["trial"] == whole[0]["trial"]
    assert sorted(r["trial"] for r in halved) == [0, 1, 2, 3]
    assert halved[0]["finished"]
    assert all(r["rung"] == 0 and r["finished"] for r in whole)
    assert halved[0]["MAE"] == pytest.approx(whole[0]["MAE"])
    # a setting that was rejected early used no more rounds than its rung gives
    assert all(r["rounds"] <= 3 * 2 ** r["rung"] for r in halved)


def test_settings_stay_in_their_ranges():
    drawn = V.draw_settings(300, seed=1)
    for name, (least, most, _) in V.SEARCH_SPACE.items():
        values = [s[name] for s in drawn]
        assert least <= min(values) < max(values) <= most
    assert drawn == V.draw_settings(300, seed=1)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_base_and_contributions_are_the_forecast(frame, kind):
    rows, inputs = frame
    if kind == "forest":
        pipeline = M.random_forest(inputs, trees=7, depth=4, leaf=1)
    else:
        pipeline = M.boosted_trees(inputs, max_iter=6, depth=3, tolerance=0.0)
    model = M.fit_global(rows, pipeline, uses_holdout=kind == "boosted")
    keys = [*PAIR, "date"]
    parts = A.contributions(rows, model.stages[-1], inputs, keys)
    total = F.col("base") + F.aggregate("parts", F.lit(0.0), lambda a, b: a + b)
    both = M.predict_global(model, rows).join(parts, keys).select("y_pred", total.alias("t")).collect()
    assert len(both) == 270
    assert all(r["t"] == pytest.approx(r["y_pred"], abs=1e-9) for r in both)
    effects = {r["feature"]: r["mean_abs_effect"] for r in A.mean_effects(parts, inputs).collect()}
    # the store decides most, noise least
    assert effects["store_nbr_code"] > effects["promo"] > effects["noise"]


def test_gain_importance_agrees_with_the_model(frame):
    rows, inputs = frame
    model = M.fit_global(rows, M.random_forest(inputs, trees=1, depth=3, bootstrap=False))
    nodes = A.tree_nodes(rows.sparkSession, model.stages[-1])
    gains = {r["feature"]: r["gain"] for r in A.gain_importance(nodes, inputs).collect()}
    want = model.stages[-1].featureImportances.toArray()
    for name, share in zip(inputs, want):
        assert gains[name] / sum(gains.values()) == pytest.approx(share)
