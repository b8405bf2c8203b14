import pytest
from pyspark.sql import functions as F

from shelfcast.plans import compare, money, reports
from tests.helpers import series

# Published money rows at z 1.6449, lead time 2, price 3.5, margin 0.25,
# holding cost 0.05.
# store, family, daily mean, naive MAPE, model MAPE, SS naive, SS model, ROP naive,
# ROP model, shortage, over naive, over model, saving per day
GOLDEN = [
    (11, "GROCERY I", 7275.393500, 14.772878, 6.024581, 2500.207822, 1019.618735, 17050.994822,
     15570.405735, 636.596931, 125.010391, 50.980937, 74.029454),
    (3, "BEVERAGES", 8434.733333, 16.094807, 7.103275, 3157.996423, 1393.748759, 20027.463090,
     18263.215426, 738.039167, 157.899821, 69.687438, 88.212383),
    (3, "GROCERY I", 7867.200000, 10.657192, 5.061687, 1950.372096, 926.338970, 17684.772096,
     16660.738970, 688.380000, 97.518605, 46.316949, 51.201656),
    (3, "PRODUCE", 7858.851727, 15.614873, 4.878374, 2854.644618, 891.843486, 18572.348071,
     16609.546939, 687.649526, 142.732231, 44.592174, 98.140057),
    (44, "BEVERAGES", 9930.400000, 24.123299, 9.056014, 5572.601004, 2091.983807, 25433.401004,
     21952.783807, 868.910000, 278.630050, 104.599190, 174.030860),
]


def test_published_money_rows(spark):
    df = spark.createDataFrame(
        [r[:5] for r in GOLDEN],
        "store_nbr int, family string, daily_mean double, `naive_MAPE_%` double, `model_MAPE_%` double",
    )
    out = money.impact_columns(money.add_prices(df, None)).collect()
    names = ["SS_naive", "SS_model", "ROP_naive", "ROP_model", "under_cost_naive", "over_cost_naive"]
    names += ["over_cost_model", "savings_over_per_day"]
    for want, got in zip(GOLDEN, out):
        assert [got[n] for n in names] == pytest.approx(list(want[5:]), abs=2e-4)
        assert got.savings_under == 0.0


def test_stock_plan(spark):
    df = series(spark, {(1, "a"): [100, *range(30)], (1, "b"): [4]})
    got = {r.family: r for r in money.stock_plan(df).collect()}
    assert got["a"].daily_mean == 14.5
    assert got["a"].safety_stock == pytest.approx(1.65 * 8.803408 * 2**0.5, abs=1e-5)
    assert got["a"].reorder_point == pytest.approx(29 + got["a"].safety_stock)
    assert (got["b"].daily_std, got["b"].reorder_point) == (0.0, 8.0)


def test_missing_metrics_stay_null(spark):
    df = series(spark, {(1, "a"): [float(i % 7 + 1) for i in range(60)], (1, "b"): [1, 2]})
    report = money.impact_report(df, None, None)
    got = {r.family: r for r in report.collect()}
    assert got["a"].SS_naive > 0 and got["a"].SS_model is None
    assert got["a"].savings_under is None and got["b"]["naive_MAPE_%"] is None
    total = money.impact_summary(report).first()
    assert (total.pairs, total.pairs_with_model, total.savings_under) == (2, 0, 0.0)


def test_first_metric_row_wins(spark):
    metrics = spark.createDataFrame(
        [(1, "a", 2.0, 20.0), (1, "a", 1.0, 10.0)],
        "store_nbr int, family string, MAE double, `MAPE_%` double",
    )
    got = money.add_model_mape(series(spark, {(1, "a"): [1], (1, "b"): [1]}), metrics)
    assert {r.family: r["model_MAPE_%"] for r in got.collect()} == {"a": 10.0, "b": None}


def test_price_lookup(spark):
    prices = spark.createDataFrame(
        [("a", 2.0, 0.5, 0.1, None), ("a", 3.0, None, None, 7), ("c", 9.0, 0.5, 0.1, 1)],
        "family string, price double, margin_rate double, holding_cost double, store_nbr int",
    )
    pairs = series(spark, {(7, "a"): [1], (8, "a"): [1], (8, "b"): [1]})
    got = {(r.store_nbr, r.family): r for r in money.add_prices(pairs, prices).collect()}
    assert (got[(7, "a")].price, got[(7, "a")].margin_rate) == (3.0, 0.5)
    assert (got[(8, "a")].price, got[(8, "b")].price) == (2.0, 3.5)
    flat = money.add_prices(pairs, prices, store_override=False).filter("store_nbr = 7").first()
    assert flat.price == 2.0


def test_single_pair_money_defaults(spark):
    df = series(spark, {(1, "a"): [10.0] * 30})
    got = money.pair_money(df, None).first()
    assert (got.mape_pct, got.sigma) == (20.0, 2.0)
    assert got.safety_stock == pytest.approx(1.6449 * 2 * 2**0.5)
    assert got.under_cost == pytest.approx(0.05 * 10 * 2 * 0.25 * 3.5)


@pytest.fixture(scope="module")
def metrics(spark):
    rows = [(1, "a", 4.0, 40.0), (1, "b", 2.0, 20.0), (2, "a", 6.0, 10.0), (None, "c", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "store_nbr int, family string, MAE double, `MAPE_%` double")
    extra = ["CV_MAE", "CV_MAPE_%", "NAIVE_LAG7_MAE", "NAIVE_LAG7_MAPE_%"]
    extra += ["NAIVE_MA7_MAE", "NAIVE_MA7_MAPE_%"]
    return df.withColumns({c: F.col("MAE") + 1 for c in extra})


def test_reports(metrics):
    tables = reports.metrics_report(metrics, 2)
    assert [(r.store_nbr, r.MAE) for r in tables["by_store"].collect()] == [(1, 3.0), (2, 6.0)]
    assert tables["summary"].first().models == 4
    assert [r.MAE for r in tables["worst"].collect()] == [6.0, 4.0]
    assert [r.MAE for r in tables["baselines"].collect()] == [1.0, 2.0]
    assert "NAIVE_MA7_MAE" in tables["baselines"].columns


def test_leaderboard(spark, metrics):
    sales = series(spark, {(1, "a"): [8.0] * 40, (2, "a"): [0.0] * 40})
    got = reports.leaderboard(metrics, sales, metric="MAPE_%", n=2, valid_days=10).collect()
    assert [(r.store_nbr, r.family) for r in got] == [(1, "a"), (1, "b")]
    assert got[0]["wMAPE_%_est"] == pytest.approx(50.0) and got[1]["wMAPE_%_est"] is None
    only = reports.leaderboard(metrics, sales, stores=[2], valid_days=10).collect()
    assert len(only) == 1 and only[0]["wMAPE_%_est"] is None


def test_resampled_errors_count_empty_bins(spark):
    held = series(spark, {(1, "a"): [4.0] * 10}).filter("date < '2024-01-04'")
    later = series(spark, {(1, "a"): [6.0]}, start=70)
    held = held.unionByName(later).withColumn("y_pred", F.col("sales") + 2)
    # January 12 against 18, February empty, March 6 against 8
    month = compare.resampled_errors(held, "M").first()
    assert month.MAE == pytest.approx((6 + 0 + 2) / 3)
    assert month["MAPE_%"] == pytest.approx((6 / 12 + 0 + 2 / 6) / 3 * 100)
    assert compare.resampled_errors(held, "M", skip_empty=True).first().MAE == pytest.approx(4)
    assert compare.resampled_errors(held, "W").first().MAE == pytest.approx(8 / 11)


def test_model_comparison(spark):
    tail = series(spark, {(1, "a"): [10, 20], (1, "b"): [1, 1], (1, "c"): [30, 30]})
    tail = tail.withColumns(
        {"p": F.col("sales") + 2, "q": F.when(F.col("family") != "c", F.col("sales") - 1)}
    )
    pairs = spark.createDataFrame([(1, f) for f in "abcdef"], "store_nbr int, family string")
    tail = tail.unionByName(
        series(spark, {(1, "f"): [9]}).withColumns({"p": F.lit(None).cast("double"), "q": F.lit(1.0)})
    )
    fitted = pairs.filter("family != 'e'")
    out = compare.compare_on_tail(pairs, fitted, tail, "p", "q", min_tail_sales=5)
    kept = compare.compared(out).collect()
    assert len(kept) == 1 and kept[0].GAIN_B_vs_A_MAE == 1.0
    reasons = {r.family: r.reason for r in compare.skipped(out).collect()}
    assert reasons == {
        "b": "tail_sum<5",
        "c": "no B prediction",
        "d": "empty tail",
        "e": "no A model",
        "f": "no A prediction",
    }
    runs = {"m": (spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "MAE double, `MAPE_%` double"), "x")}
    assert tuple(compare.model_summary(runs).first()) == ("m", 2.0, 3.0, "x")
