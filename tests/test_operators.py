import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import evaluate as E
from shelfcast.operators import resample as R
from shelfcast.operators import select as S
from shelfcast.operators import split as X
from tests.helpers import day, series


def test_resample_keeps_empty_bins(spark):
    rows = [(0, 1.0), (6, 2.0), (7, 4.0), (21, 8.0)]
    df = spark.createDataFrame([(day(n), v) for n, v in rows], "date date, v double")
    weeks = R.resample(df, ["v"], "W", "sum").orderBy("bin").collect()
    assert [r.v for r in weeks] == [3, 4, 0, 8]
    assert weeks[0].bin == dt.date(2024, 1, 7)
    means = R.resample(df, ["v"], "W", "mean").orderBy("bin").collect()
    assert [r.v for r in means] == [1.5, 4, None, 8]


def test_resample_months(spark):
    rows = [(dt.date(2024, 1, 31), 1.0), (dt.date(2024, 4, 1), 2.0)]
    df = spark.createDataFrame(rows, "date date, v double")
    got = R.resample(df, ["v"], "M").orderBy("bin").collect()
    assert [(r.bin.month, r.bin.day, r.v) for r in got] == [
        (1, 31, 1.0),
        (2, 29, 0.0),
        (3, 31, 0.0),
        (4, 30, 2.0),
    ]


def test_impute_transactions(spark):
    base = spark.createDataFrame(
        [(1, day(0), "a", 10.9, None), (1, day(1), "a", 0.0, 0.0), (1, day(2), "a", 9.0, 99.0)],
        "store_nbr int, date date, family string, sales double, transactions double",
    )
    got = R.impute_transactions(base, 2, 50).orderBy("date").collect()
    assert [r.n_tickets for r in got] == [7, 2, 50]


def test_heatmap_fills_absent_cells(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 4.0), (2, "b", 6.0)], "s int, f string, v double")
    got = {r.s: (r.a, r.b) for r in R.gain_heatmap(df, "s", "f", "v").collect()}
    assert got == {1: (2.0, 0.0), 2: (0.0, 5.0)}


def test_profiles(spark):
    df = series(spark, {(1, "a"): [1, 3, 5, 7, 9, 11, 13, 15]}).withColumn("onpromotion", F.lit(0.0))
    got = {(r.dimension, r.value): r for r in R.sales_profiles(df).collect()}
    assert got[("dayofweek", 0)].mean_sales == 8.0
    assert got[("promo", 0)].n == 8
    assert got[("dayofweek", 1)].ci_low is None


def test_holdout_counts_back_from_each_pair(spark):
    df = series(spark, {(1, "a"): range(10), (1, "b"): range(4)})
    by_pair = X.split_counts(X.add_holdout(df, 3)).orderBy("family").collect()
    assert [(r.n_valid, r.n_train) for r in by_pair] == [(3, 7), (3, 1)]
    overall = X.split_counts(X.add_holdout(df, 3, "global")).orderBy("family").collect()
    assert [r.n_valid for r in overall] == [3, 0]


def test_gates(spark):
    counts = spark.createDataFrame(
        [(40, 14, 26), (40, 13, 27), (26, 14, 12), (10, 7, 3)],
        "n_rows long, n_valid long, n_train long",
    )
    got = counts.select(X.basic_gate().alias("b"), X.forest_gate(28).alias("f")).collect()
    assert [tuple(r) for r in got] == [(True, True), (True, False), (True, False), (True, False)]


def test_folds_step_back_from_the_last_date(spark):
    df = series(spark, {(1, "a"): range(30)})
    w = X.fold_windows(df, 3, 7, 5).orderBy("fold").collect()
    assert [(r.fold_start, r.fold_end) for r in w] == [
        (day(13), day(19)),
        (day(18), day(24)),
        (day(23), day(29)),
    ]
    rows = X.expand_folds(df, X.fold_windows(df, 3, 7, 5), "past_only")
    first = rows.filter("fold = 0")
    assert first.filter("in_train").count() == 13 and first.filter("in_fold").count() == 7
    outside = X.expand_folds(df, X.fold_windows(df, 3, 7, 5)).filter("fold = 0")
    assert outside.filter("in_train").count() == 23


def test_strict_moving_average(spark):
    flat = [2.0] * 15
    df = series(spark, {(1, "a"): [*flat, 4.0], (1, "b"): flat[:10]})
    got = {r.family: r["naive_MAPE_%"] for r in E.strict_ma7_mape(df, 4).collect()}
    assert got["a"] == pytest.approx((0 + 0 + 0 + 50) / 4)
    assert got["b"] is None


def test_lag_baseline_skips_missing(spark):
    df = E.add_baselines(series(spark, {(1, "a"): [1, 2, 3, 4, 5, 6, 7, 11]}))
    got = E.error_metrics(df, {"": "naive_lag7"}).first()
    assert (got.MAE, got["MAPE_%"]) == (10.0, pytest.approx(1000 / 11))


def test_top_pairs_break_ties_by_pair(spark):
    df = series(spark, {(2, "a"): [5], (1, "b"): [5], (1, "a"): [1, 1], (3, "z"): [9]})
    got = [(r.store_nbr, r.family) for r in S.top_pairs(df, 3).collect()]
    assert got == [(3, "z"), (1, "b"), (2, "a")]
    assert S.top_pairs(df, 9, recent_days=1).count() == 1


def test_edge_stores(spark):
    df = series(spark, {(n, "a"): [1] for n in range(1, 8)})
    got = [r.store_nbr for r in S.edge_store_pairs(df, 2).collect()]
    assert got == [1, 2, 6, 7]
    assert S.edge_store_pairs(df, 5).count() == 7
    assert S.edge_store_pairs(df, 2, stores=[1, 4, 7]).count() == 2
    assert S.edge_store_pairs(df, 2, max_pairs=3).count() == 3


def test_ordinal_codes_follow_value_order(spark):
    values = ["pear", "peach", "apple", None, "plum", "apple"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = {r.c: r.c_code for r in S.encode_categories(df, ["c"]).collect()}
    assert got == {"apple": 0, "peach": 1, "pear": 2, "plum": 3, None: -1}
    numbers = spark.createDataFrame([(5000,), (-3,), (7,)], "n int")
    coded = {r.n: r.n_code for r in S.encode_categories(numbers, ["n"]).collect()}
    assert coded == {-3: 0, 7: 1, 5000: 2}


def test_align_features(spark):
    df = spark.createDataFrame([("1.5", None)], "a string, b double")
    row = S.align_features(df, ["b", "c", "a"], numeric=True).first()
    assert tuple(row) == (0.0, 0.0, 1.5)
    assert S.align_features(df, ["a"]).first().a == "1.5"


def test_members_empty_list_keeps_all(spark):
    df = series(spark, {(1, "a"): [1], (2, "b"): [2]})
    assert S.members(df, [], None).count() == 2
    assert S.members(df, [1], ["a", "b"]).count() == 1


def test_nan_becomes_null_and_rounding_is_half_even(spark):
    df = spark.createDataFrame([(float("nan"), 0.125), (1.0, 0.375)], "x double, y double")
    assert [r.x for r in S.clean_nulls(df, ["x"]).collect()] == [None, 1.0]
    assert [r.x for r in S.clean_nulls(df, ["x"], 0.0).collect()] == [0.0, 1.0]
    assert [r.y for r in S.round_display(df, ["y"]).collect()] == [0.12, 0.38]


def test_wmape(spark):
    metrics = spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0)], "store_nbr int, family string, MAE double")
    totals = E.tail_totals(series(spark, {(1, "a"): [4, None, 6]}))
    got = {r.family: r["wMAPE_%_est"] for r in E.add_wmape(metrics, totals).collect()}
    assert got == {"a": pytest.approx(40.0), "b": None}
