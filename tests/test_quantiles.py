"""Exact quantiles by selection, and regressions at a quantile, against brute force."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import ranks
from shelfcast.plans import quantiles as Q


def brute_loss(x: np.ndarray, y: np.ndarray, q: float) -> float:
    """Least pinball loss of all lines through as many rows as there are coefficients."""
    best = np.inf
    for rows in combinations(range(len(y)), x.shape[1]):
        part = x[list(rows)]
        if np.linalg.matrix_rank(part) == x.shape[1]:
            r = y - x @ np.linalg.solve(part, y[list(rows)])
            best = min(best, np.maximum(q * r, (q - 1) * r).sum())
    return best


@pytest.fixture(scope="module")
def skewed(spark):
    """One pair holds most rows; one has a single value, one a single row, one only NULL."""
    rng = np.random.default_rng(3)
    values = {
        (1, "hot"): np.concatenate([rng.gamma(1, 1e3, 4000), np.full(3000, 7.0), [1e9, -1e9]]),
        (1, "same"): np.full(900, 3.5),
        (2, "one"): np.array([4.0]),
        (2, "few"): rng.normal(0, 1, 11),
    }
    rows = [(s, f, float(v)) for (s, f), vs in values.items() for v in vs] + [(3, "none", None)]
    frame = spark.createDataFrame(rows, "store_nbr int, family string, v double")
    return values, frame.repartition(5)


@pytest.mark.parametrize(("limit", "bins"), [(20_000, 1024), (50, 16), (1, 2)])
def test_selection_equals_numpy(skewed, limit, bins):
    values, frame = skewed
    wanted = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = ranks.grouped_quantiles(frame, "v", wanted, limit=limit, bins=bins).collect()
    have = {(r["store_nbr"], r["family"], r["quantile"]): r["value"] for r in found}
    want = {(s, f, q): np.quantile(v, q) for (s, f), v in values.items() for q in wanted}
    assert have.keys() == want.keys()
    assert all(have[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) for k in want)


@pytest.mark.parametrize("local_rows", [50_000, 10])
def test_quantile_fits_equal_brute_force(spark, local_rows):
    rng = np.random.default_rng(8)
    frames = []
    for store, n in ((1, 40), (2, 25), (3, 7), (4, 1)):
        a, b = rng.integers(0, 9, n), rng.normal(1000, 1, n)
        y = 5 + 2 * a + rng.gamma(2, 3, n) * (1 + a)
        frames.append(pd.DataFrame({"store_nbr": store, "family": "f", "sales": y, "a": a, "b": b, "flat": 2.0}))
    data = pd.concat(frames)
    df = spark.createDataFrame(data)
    fitted = Q.fit_quantiles(df, ["a", "b", "flat"], F.lit(True), [0.5, 0.9], local_rows=local_rows).collect()
    assert len(fitted) == 8
    for r in fitted:
        own = data[data["store_nbr"] == r["store_nbr"]]
        x, y = own[["a", "b", "flat"]].to_numpy(float), own["sales"].to_numpy()
        residual = y - x @ np.array(r["weights"]) - r["intercept"]
        loss = np.maximum(r["quantile"] * residual, (r["quantile"] - 1) * residual).sum()
        assert loss / len(y) == pytest.approx(r["loss"], abs=1e-6)
        base = np.column_stack([np.ones(len(y)), x[:, :2]])
        least = brute_loss(base, y, r["quantile"]) if len(y) > 3 else 0.0
        assert loss == pytest.approx(least, rel=1e-7, abs=1e-6)
        assert r["weights"][2] == 0


def test_spread_follows_the_features(spark):
    """P90 minus P50 grows with the input, which a shifted point forecast cannot do."""
    rng = np.random.default_rng(5)
    a = np.tile(np.arange(10.0), 60)
    y = 3 * a + rng.exponential(1 + a)
    df = spark.createDataFrame(pd.DataFrame({"store_nbr": 1, "family": "f", "sales": y, "a": a}))
    params = Q.fit_quantiles(df, ["a"], F.lit(True))
    slopes = {r["quantile"]: r["weights"][0] for r in params.collect()}
    assert slopes[0.9] > slopes[0.5] + 1
    held = Q.quantile_coverage(Q.score_quantile_models(df, params, ["a"])).collect()
    assert {r["quantile"]: round(r["coverage"], 2) for r in held} == {0.5: 0.5, 0.9: 0.9}
