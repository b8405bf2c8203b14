"""Written layouts, versioned registries and the bootstrap."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import resample as R
from shelfcast.operators.windows import Rolling, add_rolling
from shelfcast.sources import raw, warehouse
from shelfcast.streaming import scoring as stream
from tests.helpers import day, random_series, series

SPEC = [Rolling("sales", (1, 7), (7,))]


def test_bucketed_table_needs_no_exchange_or_sort(spark, tmp_path):
    df = series(spark, random_series(4, pairs=9, longest=60)).repartition(3)
    table = warehouse.write_bucketed(df, "panel_buckets_test", str(tmp_path / "b"), buckets=4)
    try:
        found = add_rolling(table, SPEC)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange" not in plan and "Sort " not in plan
        assert sorted(map(str, found.collect())) == sorted(map(str, add_rolling(df, SPEC).collect()))
    finally:
        spark.sql("DROP TABLE panel_buckets_test")


def test_replacing_a_period_leaves_the_others(spark, tmp_path):
    df = series(spark, {(1, "a"): list(range(100)), (2, "a"): list(range(80))})
    path = warehouse.write_periods(df, str(tmp_path / "p"))

    def files():
        return {str(f): os.stat(f).st_mtime_ns for f in Path(path).rglob("*.parquet")}

    before = files()
    february = df.filter(F.month("date") == 2).withColumn("sales", F.lit(-1.0))
    warehouse.write_periods(february, path)
    after = files()
    same = {f for f in before if "period=2024-02" not in f}
    assert len(same) >= 3 and all(after[f] == before[f] for f in same)
    assert not any(f in after for f in before if "period=2024-02" in f)
    got = spark.read.parquet(path)
    assert got.count() == 180
    assert got.filter("sales = -1").count() == february.count()


@pytest.fixture
def registry(spark):
    schema = "store_nbr int, family string, kind string, quantile double, features array<string>, weights array<double>, intercept double"
    return spark.createDataFrame([(1, "a", "trend", None, ["trend"], [2.0], 1.0)], schema)


def test_stream_sees_new_models_and_replays_add_nothing(spark, registry, tmp_path):
    folder, out, state, root = (str(tmp_path / n) for n in ("requests", "out", "state", "registries"))
    with pytest.raises(ValueError):
        stream.current_registry(spark, root)

    def ask(first):
        rows = [(1, "a", day(first + i), {"trend": float(first + i)}) for i in range(3)]
        spark.createDataFrame(rows, stream.REQUEST_DDL).write.mode("append").parquet(folder)
        stream.score_batches(stream.read_requests(spark, folder), root, out, state).awaitTermination()

    assert stream.publish_registry(registry, root) == 1
    ask(0)
    assert stream.publish_registry(registry.withColumn("intercept", F.lit(100.0)), root) == 2
    # a version that is not complete is not read
    (tmp_path / "registries" / "version-3").mkdir()
    ask(10)
    got = {r["date"]: (r["pred_qty"], r["registry_version"]) for r in spark.read.parquet(out).collect()}
    want = {day(i): (2.0 * i + 1, 1) for i in range(3)} | {day(i): (2.0 * i + 100, 2) for i in range(10, 13)}
    assert got == want
    # a start without new requests, and a batch that is run again
    stream.score_batches(stream.read_requests(spark, folder), root, out, state).awaitTermination()
    batch = spark.createDataFrame([(1, "a", day(0), {"trend": 0.0})], stream.REQUEST_DDL)
    for _ in range(2):
        stream.answer_batch(batch, 77, root, out)
    assert spark.read.parquet(out).count() == 7


def test_bootstrap_agrees_with_the_normal_interval(spark):
    rng = np.random.default_rng(6)
    rows = [(i, day(i % 300), float(v), float(i % 3)) for i, v in enumerate(rng.gamma(2, 10, 6000))]
    rows.append((6000, day(0), None, 0.0))
    df = spark.createDataFrame(rows, "id long, date date, sales double, onpromotion double")
    boot = {(r["dimension"], r["value"]): r for r in R.bootstrap_profiles(df, 100).collect()}
    again = {(r["dimension"], r["value"]): r for r in R.bootstrap_profiles(df.repartition(7), 100).collect()}
    normal = {(r["dimension"], r["value"]): r for r in R.sales_profiles(df).collect()}
    assert boot.keys() == normal.keys()
    for key, r in boot.items():
        assert again[key]["ci_low"] == pytest.approx(r["ci_low"]) and r["n"] == normal[key]["n"]
        half = normal[key]["ci_high"] - normal[key]["mean_sales"]
        for side in ("ci_low", "ci_high"):
            # the ends of 100 replicates scatter by about a third of the half-width
            assert abs(r[side] - normal[key][side]) < 0.6 * half


def test_poisson_weights_have_mean_and_variance_one(spark):
    w = R.poisson_weights(F.col("id"), 6)
    got = spark.range(20_000).select(*[c.alias(f"w{i}") for i, c in enumerate(w)]).toPandas()
    assert np.allclose(got.mean(), 1, atol=0.03) and np.allclose(got.var(), 1, atol=0.05)
    assert abs(np.corrcoef(got.T.to_numpy()) - np.eye(6)).max() < 0.03


def test_validation_names_what_is_wrong(spark, tmp_path):
    (tmp_path / "train.csv").write_text("date,store_nbr,family,sales,onpromotion,more\n")
    (tmp_path / "oil.csv").write_text("date\n2024-01-01\n")
    (tmp_path / "stores.csv").write_text("store_nbr,city,state,type,cluster\n1,x,y,A,2\n")
    (tmp_path / "holidays_events.csv").write_text("")
    report = {r["file"]: (r["status"], r["missing"]) for r in raw.validate_inputs(spark, str(tmp_path)).collect()}
    assert report["train.csv"] == ("OK", []) and report["stores.csv"] == ("OK", [])
    assert report["oil.csv"] == ("BAD COLS", ["dcoilwtico"])
    assert report["transactions.csv"][0] == "MISSING"
    assert report["holidays_events.csv"] == ("BAD COLS", ["date", "locale", "type"])
    assert not raw.inputs_valid(raw.validate_inputs(spark, str(tmp_path)))
