import datetime as dt

import numpy as np
import pandas as pd
import pytest

from shelfcast.session import fresh_path
from shelfcast.sources.bindings import Retail


@pytest.fixture(scope="module")
def star(spark):
    """A small star schema in which one part and one supplier hold a third of the lines."""
    rng = np.random.default_rng(5)
    n = 3000
    hot = rng.random(n) < 1 / 3
    lines = pd.DataFrame(
        {
            "l_orderkey": rng.integers(0, 400, n),
            "l_partkey": np.where(hot, 0, rng.integers(0, 30, n)),
            "l_suppkey": np.where(hot, 0, rng.integers(0, 12, n)),
            "l_linenumber": rng.integers(1, 8, n).astype("int32"),
            "l_quantity": rng.integers(1, 51, n).astype(float),
            "l_discount": rng.integers(0, 11, n) / 100,
            "l_shipdate": pd.Timestamp("1996-04-20") + pd.to_timedelta(rng.integers(0, 60, n), "D"),
        }
    )
    supplier = pd.DataFrame({"s_suppkey": range(12), "s_nationkey": [k % 5 for k in range(12)]})
    part = pd.DataFrame(
        {
            "p_partkey": range(30),
            "p_type": [f"T{k % 4}" for k in range(30)],
            "p_retailprice": [900.0 + k for k in range(30)],
        }
    )
    nation = pd.DataFrame(
        {"n_nationkey": range(5), "n_name": [f"N{k}" for k in range(5)], "n_regionkey": [0, 1, 2, 0, 1]}
    )
    region = pd.DataFrame({"r_regionkey": range(3), "r_name": ["R0", "R1", "R2"]})
    folder = fresh_path(spark, "star")
    tables = {"supplier": supplier, "part": part, "nation": nation, "region": region}
    for name, frame in {"lineitem": lines, **tables}.items():
        spark.createDataFrame(frame).write.parquet(f"{folder}/{name}.parquet")
    return Retail(spark, folder), lines, supplier, part


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_panel_with_a_hot_key(spark, star, threshold):
    retail, lines, supplier, part = star
    joined = lines.merge(supplier, left_on="l_suppkey", right_on="s_suppkey").merge(
        part, left_on="l_partkey", right_on="p_partkey"
    )
    joined["promo"] = (joined.l_discount >= 0.05).astype(float)
    want = joined.groupby(["l_shipdate", "s_nationkey", "p_type"]).agg(
        sales=("l_quantity", "sum"), promo=("promo", "sum")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = retail.panel.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == len(want)
    for r in got:
        row = want.loc[(pd.Timestamp(r.date), r.store_nbr, r.family)]
        assert (r.sales, r.onpromotion) == (row.sales, row.promo)


def test_transactions_count_orders_once(star):
    retail, lines, supplier, _ = star
    joined = lines.merge(supplier, left_on="l_suppkey", right_on="s_suppkey")
    want = joined.groupby(["l_shipdate", "s_nationkey"]).l_orderkey.nunique()
    got = retail.transactions.collect()
    assert len(got) == len(want)
    assert all(r.transactions == want[(pd.Timestamp(r.date), r.store_nbr)] for r in got)


def test_holiday_rules(star):
    retail = star[0]
    rows = retail.holidays.collect()
    national = [r for r in rows if r.locale == "National"]
    assert [(r.date, r.transferred) for r in national] == [(dt.date(1996, 5, 1), True)] * 2
    regional = {(r.date.month, r.date.day, r.locale_name) for r in rows if r.locale == "Regional"}
    assert regional == set()  # April 10 precedes the data, May and June have no region
    local = {(r.date, r.locale_name) for r in rows if r.locale == "Local"}
    assert local == {(dt.date(1996, 5, 5), "N4")}
