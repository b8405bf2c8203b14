"""Linear models fitted at a quantile: pinball loss per pair, all pairs and quantiles at once.

The loss is smoothed over a width that shrinks from pass to pass. Each pass is one set of
grouped sums: the smoothed loss at the coefficients on trial, and its gradient and second
derivatives for the next, narrower width. A trial that lowers the smoothed loss is followed
by a Newton step, any other is drawn back towards the last good one. Pairs that have settled
are left out of the following passes. An optimum of the pinball loss passes through as many
rows as there are coefficients; so in the end the rows nearest to each fit are solved
exactly, and the better of both fits stays.

Pairs of up to LOCAL_ROWS training rows run the same passes inside one task; only longer ones
are summed over the cluster, pass by pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from shelfcast.functions.vectors import coerce_feature
from shelfcast.schemas import PAIR
from shelfcast.session import materialize

PASSES = 40
SHRINK = 0.7
# training rows of a pair that one task may hold
LOCAL_ROWS = 50_000
# share of a rejected step that is tried next
BACK = 0.25
# last width as a share of the first, and the relative decrease of the loss that still counts
LEAST = 1e-3
SETTLED = 1e-7
# least curvature of a row, so that distant rows still count a little
CURVED = 1e-9


def pinball(y: Column, p: Column, q: Column) -> Column:
    """Loss of a forecast of quantile q: q per unit too low, 1 - q per unit too high."""
    return F.greatest(q * (y - p), (q - 1) * (y - p))


def _dot(weights: str, vector: str) -> Column:
    products = F.zip_with(weights, vector, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def fit_quantiles(
    df: DataFrame,
    features: Sequence[str],
    is_train: Column,
    quantiles: Sequence[float] = (0.5, 0.9),
    keys: Sequence[str] = PAIR,
    y: str = "sales",
    passes: int = PASSES,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """(keys, quantile, weights, intercept, n, loss) of each pair's training rows; `loss` is
    the mean pinball loss. Columns that do not vary get no weight."""
    keys, k = list(keys), len(features)
    x = F.array(*[coerce_feature(F.col(c)) for c in features])
    train = df.filter(is_train & F.col(y).isNotNull()).select(*keys, F.col(y).alias("_y"), x.alias("_x"))
    stats = train.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(F.col("_x")[i]) for i in range(k)]).alias("_mean"),
        F.array(*[F.stddev_pop(F.col("_x")[i]) for i in range(k)]).alias("_sd"),
        F.avg("_y").alias("_level"),
    )
    stats = materialize(stats, "quantile-stats")

    def scaled(i: int) -> Column:
        x, mean, sd = (F.col(c)[i] for c in ("_x", "_mean", "_sd"))
        still = sd <= 1e-9 * F.greatest(F.lit(1.0), F.abs(mean))
        return F.when(still, 0.0).otherwise((x - mean) / sd)

    rows = train.join(stats, keys).select(
        *keys, "_y", F.array(F.lit(1.0), *[scaled(i) for i in range(k)]).alias("_z")
    )
    rows = materialize(rows, "quantile-rows")
    short = stats.filter(F.col("n") <= local_rows).select(*keys)
    best = _fitted_locally(rows.join(short, keys, "left_semi"), keys, quantiles, passes)
    long = stats.filter(F.col("n") > local_rows)
    if not long.isEmpty():
        rows = rows.join(long.select(*keys), keys, "left_semi")
        best = best.unionByName(_fitted_by_sums(rows, long, keys, quantiles, passes, k))
    weights = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.when(F.col("_sd")[i] > 0, F.col("beta")[i + 1] / F.col("_sd")[i]).otherwise(0.0),
    )
    fitted = best.join(stats.drop("_level"), keys).withColumn("weights", weights)
    return fitted.select(
        *keys,
        "quantile",
        "weights",
        (F.col("beta")[0] - _dot("weights", "_mean")).alias("intercept"),
        "n",
        (F.col("loss") / F.col("n")).alias("loss"),
    )


def _fitted_locally(
    rows: DataFrame, keys: list[str], quantiles: Sequence[float], passes: int
) -> DataFrame:
    """(keys, quantile, beta, loss) of pairs that one task may hold."""
    wanted = [float(q) for q in quantiles]
    shrink, back, share, settled, floor = SHRINK, BACK, LEAST, SETTLED, CURVED

    # nested, so that they travel with the task: workers need numpy and pandas only
    def loss_of(r: np.ndarray, q: float) -> float:
        return float(np.maximum(q * r, (q - 1) * r).sum())

    def smooth_loss(r: np.ndarray, q: float, width: float) -> float:
        return float((q * r + width * np.logaddexp(0, -r / width)).sum())

    def through_rows(y: np.ndarray, z: np.ndarray, beta: np.ndarray) -> np.ndarray:
        """The fit through the nearest rows that determine one."""
        near = np.argsort(np.abs(y - z @ beta), kind="stable")
        chosen: list[int] = []
        rest = z.copy()
        for _ in range(z.shape[1]):
            # what of each row the chosen ones do not determine yet
            size = np.sqrt((rest * rest).sum(axis=1))
            new = near[size[near] > 1e-6]
            if not len(new):
                break
            chosen.append(int(new[0]))
            axis = rest[new[0]] / size[new[0]]
            rest = rest - np.outer(rest @ axis, axis)
        return np.linalg.lstsq(z[chosen], y[chosen], rcond=None)[0]

    def fit(y: np.ndarray, z: np.ndarray, q: float) -> tuple[np.ndarray, float]:
        beta = np.zeros(z.shape[1])
        beta[0] = y.mean()
        width = max(float(np.abs(y - beta[0]).mean()), 1e-9)
        least, good, smooth, best = width * share, beta, np.inf, (np.inf, beta)
        for _ in range(passes):
            r = y - z @ beta
            now = smooth_loss(r, q, width)
            if now > smooth:
                beta = good + (beta - good) * back
                continue
            if (own := loss_of(r, q)) < best[0]:
                best = (own, beta)
            if width <= least and smooth - now <= settled * now:
                break
            width = max(width * shrink, least) if np.isfinite(smooth) else width
            smooth, good = smooth_loss(r, q, width), beta
            below = 1 / (1 + np.exp(np.clip(r / width, -700, 700)))
            curved = np.maximum(below * (1 - below), floor) / width
            square = (z * curved[:, None]).T @ z
            beta = beta - np.linalg.lstsq(square, z.T @ (below - q), rcond=1e-12)[0]
        exact = through_rows(y, z, best[1])
        own = loss_of(y - z @ exact, q)
        return (exact, own) if own < best[0] else (best[1], best[0])

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        y, z = part["_y"].to_numpy(dtype=float), np.stack(part["_z"].to_numpy())
        fits = [fit(y, z, q) for q in wanted]
        out = part[keys].head(1).merge(pd.DataFrame({"quantile": wanted}), how="cross")
        return out.assign(beta=[b.tolist() for b, _ in fits], loss=[v for _, v in fits])

    own = StructType([rows.schema[c] for c in keys])
    schema = own.add("quantile", "double").add("beta", ArrayType(DoubleType())).add("loss", "double")
    return rows.groupBy(*keys).applyInPandas(solve, schema)


def _fitted_by_sums(
    rows: DataFrame, stats: DataFrame, keys: list[str], quantiles: Sequence[float], passes: int, k: int
) -> DataFrame:
    """(keys, quantile, beta, loss) of pairs of any length, by passes of grouped sums."""
    # a first width that outliers do not stretch
    spread = rows.join(stats, keys).groupBy(*keys).agg(F.avg(F.abs(F.col("_y") - F.col("_level"))).alias("_w"))
    level = F.concat(F.array("_level"), F.array_repeat(F.lit(0.0), k))
    width = F.greatest("_w", F.lit(1e-9))
    start = stats.join(spread, keys).select(
        *keys,
        F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile"),
        level.alias("beta"),
        level.alias("good"),
        level.alias("best"),
        width.alias("width"),
        (width * LEAST).alias("least"),
        F.lit(float("inf")).alias("smooth"),
        F.lit(float("inf")).alias("loss"),
        F.lit(True).alias("active"),
    )
    state = materialize(start, "quantile-state")
    for _ in range(passes):
        active = state.filter("active")
        if active.isEmpty():
            break
        state = state.filter("NOT active").unionByName(_improved(rows, active, keys, k + 1))
        state = materialize(state, "quantile-state")
    return _through_rows(rows, state.withColumn("beta", F.col("best")), keys, k + 1)


def _smoothed(r: Column, q: Column, width: Column) -> Column:
    """The pinball loss of residual r with its corner rounded over a width."""
    u = r / width
    return q * r + width * (F.greatest(-u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u))))


def _improved(rows: DataFrame, state: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The state after one pass. `beta` is on trial, `good` the last that lowered the smoothed
    loss `smooth`, `best` the one with the least `loss`."""
    group, q = [*keys, "quantile"], F.col("quantile")
    first = F.col("smooth") == float("inf")
    state = state.withColumn("next", F.when(first, F.col("width")).otherwise(F.greatest(F.col("width") * SHRINK, "least")))
    met = rows.join(state, keys).withColumn("_r", F.col("_y") - _dot("beta", "_z"))
    r = F.col("_r")
    below = 1 / (1 + F.exp(r / F.col("next")))
    curved = F.greatest(below * (1 - below), F.lit(CURVED)) / F.col("next")
    met = met.withColumns({"_p": below - q, "_d": curved})
    z = [F.col("_z")[i] for i in range(k)]
    kept = ["beta", "good", "best", "width", "next", "least", "smooth", "loss"]
    sums = met.groupBy(*group).agg(
        F.array(*[F.sum(F.col("_d") * z[i] * z[j]) for i in range(k) for j in range(i, k)]).alias("_g"),
        F.array(*[F.sum(F.col("_p") * c) for c in z]).alias("_h"),
        F.sum(_smoothed(r, q, F.col("width"))).alias("_smooth"),
        F.sum(_smoothed(r, q, F.col("next"))).alias("_next"),
        F.sum(pinball(r, F.lit(0.0), q)).alias("_loss"),
        *[F.first(c).alias(c) for c in kept],
    )

    @F.pandas_udf("array<double>")
    def newton(g: pd.Series, h: pd.Series) -> pd.Series:
        upper = np.triu_indices(k)
        out = []
        for a, b in zip(g, h):
            square = np.zeros((k, k))
            square[upper] = a
            square = square + np.triu(square, 1).T
            out.append(np.linalg.lstsq(square, np.asarray(b, dtype=float), rcond=1e-12)[0].tolist())
        return pd.Series(out)

    lower = F.col("_smooth") <= F.col("smooth")
    step = F.zip_with("beta", newton("_g", "_h"), lambda b, d: b - d)
    back = F.zip_with("good", "beta", lambda a, b: a + (b - a) * BACK)
    better = F.col("_loss") < F.col("loss")
    settled = lower & (F.col("next") <= F.col("least")) & (F.abs(F.col("smooth") - F.col("_smooth")) <= SETTLED * F.col("_smooth"))
    return sums.select(
        *group,
        F.when(lower, step).otherwise(back).alias("beta"),
        F.when(lower, F.col("beta")).otherwise(F.col("good")).alias("good"),
        F.when(better, F.col("beta")).otherwise(F.col("best")).alias("best"),
        F.when(lower, F.col("next")).otherwise(F.col("width")).alias("width"),
        "least",
        F.when(lower, F.col("_next")).otherwise(F.col("smooth")).alias("smooth"),
        F.least("_loss", "loss").alias("loss"),
        (~settled).alias("active"),
    )


def _through_rows(rows: DataFrame, state: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, quantile, beta, loss): the fit through the nearest rows where that is better."""
    group = [*keys, "quantile"]
    known = state.select(*group, "beta")
    residual = F.col("_y") - _dot("beta", "_z")
    met = rows.join(known, keys).withColumn("_d", F.abs(residual))
    # equal rows are one; the rank filter is applied before the shuffle as well
    nearest = Window.partitionBy(*group).orderBy("_d", "_y", "_z")
    near = met.select(*group, "_d", "_y", "_z", F.dense_rank().over(nearest).alias("_rank"))
    near = near.filter(F.col("_rank") <= 4 * k).dropDuplicates([*group, "_rank"])
    near = near.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("_d", "_y", "_z"))).alias("_near")
    )

    @F.pandas_udf("array<double>")
    def through(ys: pd.Series, zs: pd.Series) -> pd.Series:
        out = []
        for y, z in zip(ys, zs):
            z = np.stack([np.asarray(row, dtype=float) for row in z])
            chosen: list[int] = []
            for i in range(len(z)):
                if np.linalg.matrix_rank(z[[*chosen, i]], tol=1e-9) > len(chosen):
                    chosen.append(i)
            y = np.asarray(y, dtype=float)[chosen]
            out.append(np.linalg.lstsq(z[chosen], y, rcond=None)[0].tolist())
        return pd.Series(out)

    exact = near.select(*group, through(F.col("_near._y"), F.col("_near._z")).alias("_exact"))
    both = materialize(known.join(exact, group), "quantile-candidates")
    met = rows.join(both, keys)
    losses = met.groupBy(*group).agg(
        F.sum(pinball(F.col("_y"), _dot("beta", "_z"), F.col("quantile"))).alias("_a"),
        F.sum(pinball(F.col("_y"), _dot("_exact", "_z"), F.col("quantile"))).alias("_b"),
    )
    better = F.col("_b") < F.col("_a")
    return both.join(losses, group).select(
        *group,
        F.when(better, F.col("_exact")).otherwise(F.col("beta")).alias("beta"),
        F.least("_a", "_b").alias("loss"),
    )


def score_quantile_models(df: DataFrame, params: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows repeated per quantile with the forecast `y_pred`."""
    vector = F.array(*[coerce_feature(F.col(c)) for c in features])
    scored = df.withColumn("_x", vector).join(params.select(*PAIR, "quantile", "weights", "intercept"), PAIR)
    forecast = F.col("intercept") + _dot("weights", "_x")
    return scored.withColumn("y_pred", forecast).drop("_x", "weights", "intercept")


def quantile_coverage(held: DataFrame) -> DataFrame:
    """Per pair and quantile: the share of rows at or below the forecast, and the mean loss."""
    below = (F.col("sales") <= F.col("y_pred")).cast("double")
    return held.filter("sales IS NOT NULL").groupBy(*PAIR, "quantile").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(below).alias("coverage"),
        F.avg(pinball(F.col("sales"), F.col("y_pred"), F.col("quantile"))).alias("loss"),
    )
