import pytest
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.session import fresh_path, materialize, work_dir
from shelfcast.sources import raw, warehouse
from tests.helpers import day

TRAIN_ROWS = [
    (1, day(0), 1, "BREAD/BAKERY", 1.5, 0.0),
    (2, day(1), 1, "LIQUOR,WINE,BEER", 2.5, 1.0),
    (3, day(1), 12, "A B", None, 0.0),
]


@pytest.fixture(scope="module")
def tables(spark):
    rows = {
        "train": TRAIN_ROWS,
        "transactions": [(day(0), 1, 5.0), (day(1), 12, 6.0)],
        "oil": [(day(0), 93.1), (day(1), None)],
        "holidays_events": [(day(0), "Holiday", "National", "Land", "d", True)],
        "stores": [(1, "Quito", "Pichincha", "A", 3)],
    }
    return {n: spark.createDataFrame(r, schemas.RAW_TABLES[n]) for n, r in rows.items()}


@pytest.fixture(scope="module")
def folder(spark, tables):
    return warehouse.write_raw_csv(tables, fresh_path(spark, "raw"))


def test_raw_round_trip(spark, tables, folder):
    back = raw.read_raw(spark, folder)
    for name, df in tables.items():
        assert back[name].schema == df.schema
        assert sorted(back[name].collect(), key=repr) == sorted(df.collect(), key=repr)


def test_pruned_and_limited_read(spark, folder):
    df = raw.read_raw_table(spark, folder, "train", columns=["family"], nrows=2)
    assert df.columns == ["family"] and df.count() == 2


def test_extra_and_missing_columns(spark, tables):
    folder = fresh_path(spark, "raw")
    odd = tables["oil"].select("date", F.lit("x").alias("note"))
    warehouse.write_raw_csv({"oil": odd, "stores": tables["stores"]}, folder)
    assert raw.read_raw_table(spark, folder, "oil").columns == ["date", "note"]
    report = {r.file: (r.status, r.missing) for r in raw.validate_inputs(spark, folder).collect()}
    assert report["oil.csv"] == ("BAD COLS", ["dcoilwtico"])
    assert report["stores.csv"] == ("OK", [])
    assert report["train.csv"][0] == "MISSING"
    assert not raw.inputs_valid(raw.validate_inputs(spark, folder))


def test_valid_folder(spark, folder):
    assert raw.inputs_valid(raw.validate_inputs(spark, folder))


def test_partitioned_write_keeps_types_and_odd_names(spark, tables):
    root = fresh_path(spark, "wh")
    for _ in range(2):  # a second write replaces the first
        path = warehouse.write_parquet(tables["train"], root, "train", ["store_nbr", "family"])
    back = warehouse.read_parquet(spark, path, schemas.TRAIN)
    assert back.schema == tables["train"].schema
    assert sorted(back.collect(), key=repr) == sorted(tables["train"].collect(), key=repr)
    scan = back.filter("store_nbr = 12")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(store_nbr" in scan


def test_views(spark, tables):
    root = fresh_path(spark, "wh")
    warehouse.write_warehouse(tables, root)
    assert warehouse.register_views(spark, root, "v_")[0] == "v_train"
    assert spark.sql("SELECT sum(sales) s FROM v_train").first().s == 4.0
    assert spark.sql("SELECT city FROM v_stores").first().city == "Quito"


def test_source_fallback(spark, tables, folder):
    features = fresh_path(spark, "none")
    assert raw.read_sales(spark, features, folder).count() == 3
    warehouse.write_features(tables["train"], features)
    assert raw.read_sales(spark, f"{features}/features", folder).count() == 2  # no null targets
    with pytest.raises(FileNotFoundError):
        raw.read_sales(spark, fresh_path(spark, "none"), fresh_path(spark, "none"))


def test_prices_template(tables):
    got = raw.prices_template(tables["train"]).collect()
    assert [r.family for r in got] == ["A B", "BREAD/BAKERY", "LIQUOR,WINE,BEER"]
    assert (got[0].price, got[0].margin_rate, got[0].holding_cost) == (3.5, 0.25, 0.05)


def test_run_metadata(spark):
    path = fresh_path(spark, "meta")
    summary = spark.createDataFrame([(1.5,)], "MAE double")
    warehouse.write_run_metadata(summary, {"depth": "6"}, ["a", "b"], path)
    ddl = "MAE double, params map<string,string>, features array<string>"
    row = spark.read.schema(ddl).json(path).first()
    assert tuple(row) == (1.5, {"depth": "6"}, ["a", "b"])


def test_predictions_and_metrics_sinks(spark):
    preds = spark.createDataFrame(
        [(1, "a/b", day(0), 1.0, 2.0)],
        "store_nbr int, family string, date date, y_true double, y_pred double",
    )
    path = warehouse.write_predictions(preds, fresh_path(spark, "preds"))
    assert spark.read.schema(preds.schema).parquet(path).first().family == "a/b"
    metrics = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0)], "store_nbr int, family string, MAE double")
    path = warehouse.write_metrics(metrics.coalesce(1), fresh_path(spark, "metrics"))
    assert [r.MAE for r in spark.read.option("header", True).csv(path).collect()] == ["1.0", "2.0"]


def test_work_folder_comes_from_the_session(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5), "numbers")
    assert df.count() == 5 and work_dir(spark) in df.inputFiles()[0]
