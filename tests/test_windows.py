import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import windows as W
from shelfcast.operators.evaluate import add_baselines
from shelfcast.operators.windows import Layout, Rolling, add_rolling
from tests.helpers import DAY0, day, random_series, rolling_twin, series

A, B = (1, "a"), (1, "b")


def means(df, column):
    rows = df.orderBy("store_nbr", "family", "date").collect()
    return [r[column] for r in rows]


def test_frames_stop_at_the_pair(spark):
    df = series(spark, {A: [1, 2, 3, 4], B: [10, 20, 30, 40]})
    out = add_rolling(df, [Rolling("sales", (1,), (3,))])
    assert means(out, "sales_rollmean_3") == [None, 1, 1.5, 2, None, 10, 15, 20]
    assert means(out, "sales_lag_1") == [None, 1, 2, 3, None, 10, 20, 30]


def test_frames_run_on_when_carried(spark):
    df = series(spark, {A: [1, 2, 3, 4], B: [10, 20, 30, 40]})
    out = add_rolling(df, [Rolling("sales", (1,), (3,))], Layout(boundary="carry"))
    assert means(out, "sales_rollmean_3") == [None, 1, 1.5, 2, 2.5, 6.5, 15, 20]
    assert means(out, "sales_lag_1") == [None, 1, 2, 3, None, 10, 20, 30]


@pytest.mark.parametrize("boundary", ["pair", "carry"])
@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_equal_brute_force(spark, boundary, seed):
    data = random_series(seed, pairs=9, longest=90)
    df = series(spark, data).repartition(5)
    layout = Layout(boundary=boundary, block_rows=16)
    out = add_rolling(df, [Rolling("sales", (1, 7), (7, 12))], layout)
    rows = out.collect()
    assert len(rows) == sum(len(v) for v in data.values())
    for w in (7, 12):
        want = rolling_twin(data, w, boundary == "carry")
        for r in rows:
            i = (r.date - DAY0).days
            mean, std = want[((r.store_nbr, r.family), i)]
            assert r[f"sales_rollmean_{w}"] == pytest.approx(mean)
            assert r[f"sales_rollstd_{w}"] == pytest.approx(std, abs=1e-9)
    for r in rows:
        values, i = data[(r.store_nbr, r.family)], (r.date - DAY0).days
        assert r.sales_lag_7 == (values[i - 7] if i >= 7 else None)


def test_carried_frames_over_many_stores(spark):
    """100,000 stores of one or two rows: frames run across all of them."""
    n = 150_000
    rows = spark.range(n).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"),
        (F.col("id") * 2 / 3).cast("int").alias("store_nbr"),
        F.lit("a").alias("family"),
        (F.col("id") % 97).cast("double").alias("sales"),
    )
    out = add_rolling(rows.repartition(7), [Rolling("sales", (1,), (7,))], Layout(boundary="carry"))
    # the table itself is read while its order is found and written, not by the plan
    assert "Range (0" not in out._jdf.queryExecution().toString()
    got = out.orderBy("store_nbr", "date").toPandas()
    assert got["store_nbr"].nunique() == 100_000
    shifted = got.groupby("store_nbr")["sales"].shift(1)
    want = shifted.rolling(7, min_periods=1).mean()
    pd.testing.assert_series_equal(got["sales_rollmean_7"], want, check_names=False)


def test_pair_layout_equals_block_layout_and_ignores_other_pairs(spark):
    data = random_series(3, pairs=6, longest=60)
    spec = [Rolling("sales", (1, 14), (7,))]
    columns = ["date", "store_nbr", "family", "sales_lag_14", "sales_rollmean_7"]

    def answer(df, layout=None):
        return sorted(map(tuple, add_rolling(df, spec, layout).select(*columns).collect()), key=repr)

    base = answer(series(spark, data))
    assert answer(series(spark, data), Layout(block_rows=20)) == base
    more = {**data, (0, "x"): [7.0] * 40}
    assert [r for r in answer(series(spark, more).repartition(7)) if r[1] != 0] == base


def test_one_hot_pair_is_cut_into_blocks(spark):
    df = series(spark, {A: list(range(300)), B: [1, 2]})
    placed = W.add_positions(df, Layout(block_rows=32))
    assert placed.filter("family = 'a'").agg(F.max("_pos")).first()[0] == 299
    out = add_rolling(df, [Rolling("sales", (), (7,))], Layout(block_rows=32))
    last = out.filter("family = 'a' and sales = 299").first()
    assert last.sales_rollmean_7 == 295.0


def test_tail_bounds_and_snapshot(spark):
    df = series(spark, {A: [1, 2, 3, 4], B: [5]})
    assert W.last_rows(df, 2).count() == 3
    assert sorted(r.sales for r in W.latest_snapshot(df).collect()) == [4, 5]
    ends = {r.family: (r.first_date, r.last_date) for r in W.pair_bounds(df).collect()}
    assert (ends["a"][1] - ends["a"][0]).days == 3


def test_sequences_hold_prior_rows_only(spark):
    out = W.add_sequences(series(spark, {A: [1, 2, 3, 4], B: [5, 6]}), ["sales"], 2)
    got = {r.sales: r.sequence for r in out.collect()}
    assert got == {3.0: [[1.0], [2.0]], 4.0: [[2.0], [3.0]]}


def test_scaling_is_fitted_on_training_rows(spark):
    df = series(spark, {A: [1, 3, 100], B: [5, 5, 6]})
    out = W.scale_on_train(df, ["sales"], F.col("sales") < 6)
    got = {(r.family, r.sales): r.sales_scaled for r in out.collect()}
    assert got[("a", 100.0)] == pytest.approx((100 - 2) / np.std([1, 3]))
    assert got[("b", 6.0)] == 1.0  # zero spread divides by one


def test_windows_share_one_exchange(spark):
    df = series(spark, {A: [1, 2, 3], B: [4, 5]}).withColumn("x", F.col("sales"))
    plan = add_rolling(df, [Rolling("sales", (1, 7), (7, 30)), Rolling("x", (7,), (7,))])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_rows_of_one_day_have_one_order(spark):
    rows = [(i, day(i // 3), 1, "a", float(i * i % 17), 0.0) for i in range(60)]
    names = "id long, date date, store_nbr int, family string, sales double, onpromotion double"
    answers = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, names).repartition(3)
        spec = [Rolling("sales", (1, 7), (7,))]
        pair, blocks = (add_rolling(df, spec, x) for x in (None, Layout(block_rows=16)))
        frames = [pair, blocks.select(pair.columns), W.last_rows(df, 5), add_baselines(df)]
        answers.append([sorted(map(tuple, f.collect())) for f in frames])
        for got, want in zip(answers[-1][1], answers[-1][0]):
            assert got == pytest.approx(want)
    assert answers[0][0] == answers[1][0] and answers[0][2:] == answers[1][2:]
    assert [r[0] for r in answers[0][2]] == [55, 56, 57, 58, 59]
