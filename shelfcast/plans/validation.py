"""Time folds and parameter search of the global models.

Fits are independent Spark jobs over one written frame; they are submitted from a bounded pool
of driver threads, so that the small stages at the end of one fit do not leave the cluster idle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import metrics as M
from shelfcast.operators.split import fold_columns, fold_gate, fold_training
from shelfcast.plans.models import boosted_trees, fit_global, predict_global
from shelfcast.schemas import PAIR
from shelfcast.session import materialize

WORKERS = 4
# share of the error that a round has to take away, or it is the last
TOLERANCE = 0.001

# The search space of the boosted trees, (least, most, on a log scale)
SEARCH_SPACE = {
    "n_estimators": (300, 3000, False),
    "learning_rate": (0.01, 0.2, True),
    "num_leaves": (31, 256, False),
    "min_child_samples": (10, 200, False),
    "subsample": (0.6, 1.0, False),
    "colsample_bytree": (0.6, 1.0, False),
    "lambda_l1": (1e-8, 10.0, True),
    "lambda_l2": (1e-8, 10.0, True),
}
WHOLE = {"n_estimators", "num_leaves", "min_child_samples"}


def in_parallel(spark: SparkSession, jobs: Sequence[Callable], workers: int = WORKERS) -> list:
    """Results of driver functions that run Spark jobs, in their order."""
    with ThreadPoolExecutor(max(1, workers)) as pool:
        # jobs keep the properties and tags of the session that submits them
        return list(pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs))


# ------------------------------------------------------------------ folds


def with_last_date(frame: DataFrame, scope: str) -> DataFrame:
    """Rows with the last date `last` of their pair or of the table, and `n_rows` of the pair."""
    pairs = frame.groupBy(*PAIR).agg(F.max("date").alias("last"), F.count(F.lit(1)).alias("n_rows"))
    if scope == "global":
        pairs = pairs.withColumn("last", F.lit(pairs.agg(F.max("last")).first()[0]))
    elif scope != "pair":
        raise ValueError(f"unknown scope {scope!r}")
    return frame.join(pairs, PAIR)


def global_cross_validation(
    frame: DataFrame,
    make: Callable[[], Pipeline],
    folds: int,
    valid_days: int = 28,
    step_days: int = 28,
    mode: str = "outside",
    scope: str = "global",
    log1p: bool = False,
    uses_holdout: bool = False,
    workers: int = WORKERS,
) -> DataFrame:
    """MAE and MAPE of a global model per pair and fold that passes the row gate.

    `frame` is that of `model_frame`; its own split is not used. Each fold trains a model of
    its own; `uses_holdout` lets it stop early on the rows of the fold.
    """
    dated = materialize(with_last_date(frame, scope), "fold-frame")

    def run(fold: int) -> DataFrame | None:
        inside, before = fold_columns(fold, folds, valid_days, step_days)
        part = dated.withColumn("is_valid", inside).filter(inside | fold_training(inside, before, mode))
        if part.filter(~F.col("is_valid")).isEmpty() or part.filter("is_valid").isEmpty():
            return None
        model = fit_global(part.drop("last", "n_rows"), make(), uses_holdout)
        held = predict_global(model, part.filter("is_valid"), log1p)
        scored = held.groupBy(*PAIR, F.lit(fold).alias("fold")).agg(
            M.mae(F.col("sales"), F.col("y_pred")).alias("MAE"),
            M.mape(F.col("sales"), F.col("y_pred")).alias("MAPE_%"),
            F.count(F.lit(1)).alias("n_fold"),
            F.first("n_rows").alias("n_rows"),
        )
        return materialize(scored.filter(fold_gate()), "fold-metrics")

    jobs = [lambda k=k: run(k) for k in range(folds)]
    done = [part for part in in_parallel(frame.sparkSession, jobs, workers) if part is not None]
    if not done:
        raise ValueError("no fold has rows to train on and to judge")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------ search


def draw_settings(trials: int, seed: int = 42, space: dict = SEARCH_SPACE) -> list[dict[str, float]]:
    """Seeded random settings, uniform or log-uniform in their ranges."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trials):
        setting = {}
        for name, (least, most, log) in space.items():
            value = np.exp(rng.uniform(np.log(least), np.log(most))) if log else rng.uniform(least, most)
            setting[name] = int(round(value)) if name in WHOLE else float(value)
        out.append(setting)
    return out


def trees_of(inputs: Sequence[str], setting: dict, rounds: int, seed: int = 42) -> Pipeline:
    """Boosted trees of a setting, for a target whose spread is about 1.

    Spark's trees are bounded by depth, so the leaves become the depth that holds them, and
    have no penalties on leaf values: the larger of both, in thousandths, is the least gain
    of a split.
    """
    return boosted_trees(
        inputs,
        max_iter=rounds,
        step=setting["learning_rate"],
        depth=max(1, math.ceil(math.log2(setting["num_leaves"]))),
        subsample=setting["subsample"],
        seed=seed,
        leaf=setting["min_child_samples"],
        columns=setting["colsample_bytree"],
        gain=max(setting["lambda_l1"], setting["lambda_l2"]) / 1000,
        tolerance=TOLERANCE,
    )


def successive_halving(
    frame: DataFrame,
    inputs: Sequence[str],
    settings: Sequence[dict],
    first: int = 8,
    factor: int = 4,
    workers: int = WORKERS,
    make: Callable = trees_of,
) -> DataFrame:
    """(trial, rung, rounds, best_iteration, MAE, finished), best trial first.

    All settings are fitted with `first` rounds; the best 1/factor of them, one at least, go
    on with `factor` times as many, until the last has used all rounds it asks for or stopped
    by itself on the holdout. A setting that has finished keeps its score and competes with
    the others on the next rungs without a new fit. Those rejected early are ranked by the
    rung they reached, then by their error. `frame` must be a written table.

    Trees are fitted to the label divided by its mean distance from the mean: a round on the
    absolute loss moves a forecast by the learning rate at most, whatever the label's unit.
    """
    scores: dict[int, tuple] = {}
    alive, rounds, rung = list(range(len(settings))), first, 0
    train = frame.filter("NOT is_valid")
    level = train.agg(F.avg("label")).first()[0] or 0.0
    scale = train.agg(F.avg(F.abs(F.col("label") - level))).first()[0] or 1.0
    frame = frame.withColumn("label", F.col("label") / scale)
    held = frame.filter("is_valid")

    def run(trial: int, budget: int) -> tuple[int, float]:
        asked = settings[trial]["n_estimators"]
        model = fit_global(frame, make(inputs, settings[trial], min(asked, budget)), uses_holdout=True)
        forecast = F.col("y_pred") * scale
        error = predict_global(model, held).agg(M.mae(F.col("sales"), forecast)).first()[0]
        return model.stages[-1].getNumTrees, error

    while alive:
        open_ = [t for t in alive if t not in scores or not scores[t][4]]
        jobs = [lambda t=t: run(t, rounds) for t in open_]
        for trial, (used, error) in zip(open_, in_parallel(frame.sparkSession, jobs, workers)):
            asked = settings[trial]["n_estimators"]
            budget = min(asked, rounds)
            scores[trial] = (rung, budget, used, error, used < budget or budget == asked)
        for trial in alive:
            scores[trial] = (rung, *scores[trial][1:])
        ranked = sorted(alive, key=lambda t: (scores[t][3], t))
        alive = ranked[: max(1, len(ranked) // factor)]
        if all(scores[t][4] for t in alive):
            break
        rung, rounds = rung + 1, rounds * factor
    order = sorted(scores, key=lambda t: (-scores[t][0], scores[t][3], t))
    rows = [(t, *scores[t][:3], float(scores[t][3]), scores[t][4]) for t in order]
    schema = "trial int, rung int, rounds int, best_iteration int, MAE double, finished boolean"
    return frame.sparkSession.createDataFrame(rows, schema)
