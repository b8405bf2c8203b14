import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import panel as P
from shelfcast.plans.features import FEATURE_COLUMNS, add_dimensions, feature_columns, make_features
from shelfcast.sources.raw import order_exogenous
from tests.helpers import day, series

HOLIDAY_DDL = "date date, type string, locale string, locale_name string, transferred boolean"


@pytest.fixture(scope="module")
def stores(spark):
    rows = [(1, "Quito", "Pichincha", "A", 3), (2, "Guayaquil", "Guayas", "B", 4)]
    return spark.createDataFrame(
        rows, "store_nbr int, city string, state string, type string, cluster int"
    )


@pytest.fixture(scope="module")
def holidays(spark):
    rows = [
        (day(2), "Holiday", "NATIONAL", "Land", False),
        (day(2), "Holiday", "National", "Land", False),
        (day(3), "Holiday", "National", "Land", True),
        (day(5), "Work Day", "regional", "Guayas", False),
        (day(7), "Event", "Local", "Quito", False),
    ]
    return spark.createDataFrame(rows, HOLIDAY_DDL)


@pytest.fixture(scope="module")
def panel(spark):
    return series(spark, {(1, "x"): range(10), (2, "x"): range(10)})


def by_day(df, column, store):
    rows = df.filter(F.col("store_nbr") == store).orderBy("date").collect()
    return [r[column] for r in rows]


def test_holiday_flags(spark, panel, stores, holidays):
    df = P.add_holidays(P.add_stores(panel, stores), holidays)
    assert df.count() == 20  # doubled national rows do not fan out
    assert by_day(df, "is_holiday_national", 1) == [0, 0, 1, 0, 0, 0, 0, 0, 0, 0]
    assert by_day(df, "is_holiday_regional", 2) == [0, 0, 0, 0, 0, 1, 0, 0, 0, 0]
    assert by_day(df, "is_holiday_regional", 1) == [0] * 10
    assert by_day(df, "is_holiday_local", 1) == [0, 0, 0, 0, 0, 0, 0, 1, 0, 0]
    assert by_day(df, "is_holiday", 2) == [0, 0, 1, 0, 0, 1, 0, 0, 0, 0]


def test_holiday_distance_is_global(spark, panel, stores, holidays):
    df = P.add_holiday_distance(P.add_holidays(P.add_stores(panel, stores), holidays))
    # day 5 is a holiday of store 2 only, and counts for store 1 as well
    assert by_day(df, "days_from_prev_holiday", 1) == [None, None, 0, 1, 2, 0, 1, 0, 1, 2]
    assert by_day(df, "days_to_next_holiday", 1) == [2, 1, 0, 2, 1, 0, 1, 0, None, None]
    assert by_day(df, "is_day_before_holiday", 1) == [0, 1, 0, 0, 1, 0, 1, 0, 0, 0]
    assert by_day(df, "is_day_after_holiday", 1) == [0, 0, 0, 1, 0, 0, 1, 0, 1, 0]


def test_missing_inputs_degrade(spark, panel):
    df = add_dimensions(panel)
    row = df.first()
    assert (row.is_holiday, row.transactions, row.oil_price, row.onpromotion) == (0, None, None, 0)
    assert "city" not in df.columns


def test_duplicate_transactions_fan_out(spark, panel):
    tx = spark.createDataFrame(
        [(day(0), 1, 5.0), (day(0), 1, 6.0)], "date date, store_nbr int, transactions double"
    )
    assert P.add_transactions(panel, tx).count() == 21
    assert add_dimensions(panel, transactions=tx).count() == 21
    assert P.add_transactions(panel, tx.drop("store_nbr")).count() == 22


def test_promotion_nulls_become_zero(spark, panel):
    nan = F.when(F.col("sales") > 5, F.lit(float("nan")))
    df = P.fill_promotion(panel.withColumn("onpromotion", nan))
    assert {r.onpromotion for r in df.collect()} == {0.0}


def test_table_roles_in_either_order(spark, panel, holidays):
    tx = panel.select("date", "store_nbr", F.col("sales").alias("transactions"))
    oil = panel.select("date", F.col("sales").alias("dcoilwtico"))
    assert order_exogenous(tx, oil, holidays) == (holidays, tx, oil)
    assert order_exogenous(holidays, tx, oil) == (holidays, tx, oil)
    assert order_exogenous(oil, holidays, tx) == (holidays, tx, oil)
    assert order_exogenous(tx, oil, None) == (tx, oil, None)
    both = tx.withColumn("oil_price", F.lit(1.0))
    with pytest.raises(ValueError):
        order_exogenous(both, holidays, both)


def test_calendar_against_python(spark):
    start = dt.date(2015, 12, 20)
    df = spark.range(800).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    for r in P.add_special_days(P.add_calendar(df)).collect():
        d = r.date
        assert (r.year, r.month, r.day) == (d.year, d.month, d.day)
        assert r.week == d.isocalendar()[1]
        assert r.dayofweek == d.weekday()
        assert r.quarter == (d.month - 1) // 3 + 1
        assert r.is_weekend == int(d.weekday() >= 5)
        assert r.is_month_start == int(d.day == 1)
        assert r.is_month_end == int((d + dt.timedelta(days=1)).day == 1)
        assert r.dow_sin == pytest.approx(math.sin(2 * math.pi * d.weekday() / 7), abs=1e-12)
        assert r.month_cos == pytest.approx(math.cos(2 * math.pi * (d.month - 1) / 12), abs=1e-12)
        assert r.is_christmas == int((d.month, d.day) == (12, 25))
        assert r.is_newyear == int((d.month, d.day) == (1, 1))
        friday = d.month == 11 and d.weekday() == 4 and 23 <= d.day <= 29
        assert r.is_black_friday == int(friday)


def test_feature_table_columns(spark, panel, stores, holidays):
    tx = panel.select("date", "store_nbr", F.col("sales").alias("transactions")).distinct()
    oil = panel.select("date", F.lit(50.5).alias("dcoilwtico")).distinct()
    full = panel.withColumns({"id": F.monotonically_increasing_id(), "onpromotion": F.lit(1.0)})
    df = make_features(full, holidays, tx, oil, stores)
    assert len(FEATURE_COLUMNS) == 63
    assert df.columns == FEATURE_COLUMNS
    assert df.count() == 20
    first = df.orderBy("store_nbr", "date").first()
    assert (first.trend, first.sales_lag_1, first.transactions_rollmean_7) == (0, None, None)
    assert not {"id", "date", "sales"} & set(feature_columns(df))
    assert feature_columns(df, ordered=True) == sorted(feature_columns(df))


def test_null_targets_are_dropped_after_the_windows(spark):
    df = series(spark, {(1, "x"): [1, None, 3]})
    out = make_features(df, drop_null_target=True).orderBy("date").collect()
    assert [r.sales for r in out] == [1, 3]
    assert out[1].sales_lag_1 is None and out[1].sales_rollmean_7 == 1
