"""Scans, sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.catalog.base import query
from shelfcast.catalog.settings import VALID_DAYS
from shelfcast.operators.windows import Rolling, add_rolling
from shelfcast.plans.features import FEATURE_COLUMNS
from shelfcast.plans.reports import metric_summary
from shelfcast.session import fresh_path
from shelfcast.sources import raw, warehouse

TRAIN = "id:l date:d store_nbr:i family:s sales:f onpromotion:f"
PANEL_SQL = "SELECT * FROM panel"


@query("a1_read_raw", TRAIN, PANEL_SQL)
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv({"train": s.panel}, folder)
    return raw.read_raw_table(s.spark, folder, "train")


_RAW_COUNTS = """
SELECT 'train' AS table_name, COUNT(*) AS n, MIN(date) AS first, MAX(date) AS last FROM panel
UNION ALL SELECT 'transactions', COUNT(*), MIN(date), MAX(date) FROM transactions
UNION ALL SELECT 'oil', COUNT(*), MIN(date), MAX(date) FROM oil
UNION ALL SELECT 'holidays_events', COUNT(*), MIN(date), MAX(date) FROM holidays_events
UNION ALL SELECT 'stores', COUNT(*), NULL, NULL FROM stores"""


@query("a1_read_raw_all", "table_name:s n:l first:d last:d", _RAW_COUNTS)
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv(s.raw_tables(), folder)
    parts = []
    for name, df in raw.read_raw(s.spark, folder).items():
        date = F.col("date") if "date" in df.columns else F.lit(None).cast("date")
        dated = df.agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))
        parts.append(dated.withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query(
    "a1_read_raw_values",
    "table_name:s date:d store_nbr:i name:s value:f",
    """
SELECT 'transactions' AS table_name, date, store_nbr, NULL AS name, transactions AS value FROM transactions
UNION ALL SELECT 'oil', date, NULL, NULL, dcoilwtico FROM oil
UNION ALL SELECT 'holidays_events', date, NULL, locale || '/' || locale_name || '/' || type,
                 CASE WHEN transferred THEN 1 ELSE 0 END FROM holidays_events
UNION ALL SELECT 'stores', NULL, store_nbr, city || '/' || state || '/' || type, cluster FROM stores
UNION ALL SELECT 'train', date, store_nbr, family, sales + 1000 * onpromotion FROM panel""",
)
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv(s.raw_tables(), folder)
    found = raw.read_raw(s.spark, folder)
    none = F.lit(None)
    shape = {
        "transactions": ("date", "store_nbr", none, F.col("transactions")),
        "oil": ("date", none, none, F.col("dcoilwtico")),
        "holidays_events": (
            "date", none, F.concat_ws("/", "locale", "locale_name", "type"), F.col("transferred").cast("int")
        ),
        "stores": (none, "store_nbr", F.concat_ws("/", "city", "state", "type"), F.col("cluster")),
        "train": ("date", "store_nbr", F.col("family"), F.col("sales") + 1000 * F.col("onpromotion")),
    }
    names, kinds = ["date", "store_nbr", "name", "value"], ["date", "int", "string", "double"]
    parts = []
    for table, columns in shape.items():
        columns = [F.col(c) if isinstance(c, str) else c for c in columns]
        typed = [c.cast(k).alias(n) for c, k, n in zip(columns, kinds, names)]
        parts.append(found[table].select(F.lit(table).alias("table_name"), *typed))
    return reduce(DataFrame.unionByName, parts)


_FILES = "train", "transactions", "oil", "holidays_events", "stores"


@query(
    "a2_validate_inputs",
    "file:s status:s missing:s",
    f"SELECT UNNEST({[f'{name}.csv' for name in _FILES]}) AS file, 'OK' AS status, '' AS missing",
)
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv(s.raw_tables(), folder)
    return raw.validate_inputs(s.spark, folder).withColumn(
        "missing", F.concat_ws(",", "missing")
    )


@query(
    "a2_bad_files",
    "file:s status:s missing:s",
    """
SELECT UNNEST(['train.csv', 'transactions.csv', 'oil.csv', 'holidays_events.csv', 'stores.csv']) AS file,
       UNNEST(['OK', 'BAD COLS', 'MISSING', 'BAD COLS', 'OK']) AS status,
       UNNEST(['', 'store_nbr,transactions', '', 'locale', '']) AS missing""",
)
def _(s):
    # one file lacks two columns, one lacks one, one is absent
    folder = fresh_path(s.spark, "raw")
    tables = s.raw_tables()
    tables["transactions"] = tables["transactions"].drop("store_nbr", "transactions")
    tables["holidays_events"] = tables["holidays_events"].drop("locale")
    del tables["oil"]
    warehouse.write_raw_csv(tables, folder)
    report = raw.validate_inputs(s.spark, folder)
    shown = F.when(F.col("status") == "MISSING", F.lit("")).otherwise(F.concat_ws(",", "missing"))
    return report.withColumn("missing", shown)


@query("a3_write_parquet", "date:d dcoilwtico:f", "SELECT * FROM oil")
def _(s):
    path = warehouse.write_parquet(s.oil, fresh_path(s.spark, "wh"), "oil")
    return warehouse.read_parquet(s.spark, path, schemas.OIL)


@query("a4_write_partitioned", TRAIN, PANEL_SQL)
def _(s):
    root = fresh_path(s.spark, "wh")
    path = warehouse.write_parquet(s.panel, root, "train", warehouse.PARTITIONING["train"])
    return warehouse.read_parquet(s.spark, path, schemas.TRAIN)


@query(
    "a4_bucketed_windows",
    "date:d store_nbr:i family:s sales_lag_7:f sales_rollmean_30:f",
    """
SELECT date, store_nbr, family,
       LAG(sales, 7) OVER (PARTITION BY store_nbr, family ORDER BY date) AS sales_lag_7,
       AVG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date
                        ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS sales_rollmean_30
FROM panel""",
)
def _(s):
    path = fresh_path(s.spark, "panel-buckets")
    table = warehouse.write_bucketed(s.panel.drop("id"), path.rsplit("/", 1)[1].replace("-", "_"), path, buckets=8)
    return add_rolling(table, [Rolling("sales", (7,), (30,))])


@query(
    "a4_replace_period",
    "date:d store_nbr:i family:s sales:f",
    """
SELECT date, store_nbr, family, sales * CASE WHEN date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
                                             THEN 2 ELSE 1 END AS sales FROM panel""",
)
def _(s):
    path = warehouse.write_periods(s.stored_panel, fresh_path(s.spark, "periods"))
    march = s.stored_panel.filter(F.date_format("date", "yyyy-MM") == "1998-03")
    warehouse.write_periods(march.withColumn("sales", F.col("sales") * 2), path)
    return s.spark.read.parquet(path)


@query(
    "a5_register_views",
    "table_name:s n:l",
    """
SELECT 'train' AS table_name, COUNT(*) AS n FROM panel
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
UNION ALL SELECT 'oil', COUNT(*) FROM oil
UNION ALL SELECT 'holidays_events', COUNT(*) FROM holidays_events
UNION ALL SELECT 'stores', COUNT(*) FROM stores""",
)
def _(s):
    root = fresh_path(s.spark, "wh")
    warehouse.write_warehouse(s.raw_tables(), root)
    views = warehouse.register_views(s.spark, root, prefix="wh_")
    parts = [
        f"SELECT '{v.removeprefix('wh_')}' AS table_name, COUNT(*) AS n FROM {v}" for v in views
    ]
    return s.spark.sql(" UNION ALL ".join(parts))


@query(
    "a6_feature_sink",
    "date:d store_nbr:i family:s sales:f sales_lag_1:f trend:i",
    """
SELECT date, store_nbr, family, sales, trend,
       LAG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date) AS sales_lag_1
FROM daily""",
)
def _(s):
    path = warehouse.write_features(s.features, fresh_path(s.spark, "wh"))
    return s.spark.read.parquet(path)


@query("a7_source_fallback", "date:d store_nbr:i family:s sales:f", PANEL_SQL)
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv({"train": s.panel}, folder)
    return raw.read_sales(s.spark, f"{folder}/features", folder)


@query("a7_feature_source", "date:d store_nbr:i family:s sales:f trend:i", "SELECT * FROM daily")
def _(s):
    root = fresh_path(s.spark, "wh")
    path = warehouse.write_features(s.features, root)
    return raw.read_sales(s.spark, path, f"{root}/none")


@query("a8_limited_read", "n:l", "SELECT LEAST(1000, COUNT(*)) AS n FROM panel")
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv({"train": s.panel}, folder)
    read = raw.read_raw_table(s.spark, folder, "train", nrows=1000)
    return read.agg(F.count(F.lit(1)).alias("n"))


@query(
    "a8_pruned_read",
    "family:s n:l",
    "SELECT family, COUNT(*) AS n FROM panel GROUP BY 1",
)
def _(s):
    folder = fresh_path(s.spark, "raw")
    warehouse.write_raw_csv({"train": s.panel}, folder)
    read = raw.read_raw_table(s.spark, folder, "train", columns=["family"])
    return read.groupBy("family").agg(F.count(F.lit(1)).alias("n"))


METRIC_SUMMARY_SQL = """
SELECT COUNT(*) AS models, AVG("MAE") AS "mean_MAE", AVG("MAPE_%") AS "mean_MAPE",
       AVG("CV_MAE") AS "mean_CV_MAE", AVG("CV_MAPE_%") AS "mean_CV_MAPE" FROM metrics"""
METRIC_SUMMARY = "models:l mean_MAE:f mean_MAPE:f mean_CV_MAE:f mean_CV_MAPE:f"


@query("a9_metric_sink", METRIC_SUMMARY, METRIC_SUMMARY_SQL)
def _(s):
    path = warehouse.write_metrics(s.metrics, fresh_path(s.spark, "metrics"))
    schema = s.metrics.schema
    return metric_summary(s.spark.read.option("header", True).schema(schema).csv(path))


@query(
    "a10_run_metadata",
    "MAE:f valid_days:s n_features:i",
    f"""
SELECT AVG("MAE") AS "MAE", '{VALID_DAYS}' AS valid_days, {len(FEATURE_COLUMNS)} AS n_features
FROM metrics""",
)
def _(s):
    path = warehouse.write_run_metadata(
        s.metrics.agg(F.avg("MAE").alias("MAE")),
        {"valid_days": str(VALID_DAYS)},
        FEATURE_COLUMNS,
        fresh_path(s.spark, "meta"),
    )
    ddl = "MAE double, params map<string,string>, features array<string>"
    back = s.spark.read.schema(ddl).json(path)
    return back.select(
        "MAE", F.col("params.valid_days").alias("valid_days"), F.size("features").alias("n_features")
    )


@query(
    "a11_prediction_sink",
    "store_nbr:i family:s date:d y_true:f y_pred:f",
    "SELECT store_nbr, family, date, sales AS y_true, y_pred FROM held",
)
def _(s):
    path = warehouse.write_predictions(
        s.held.withColumnRenamed("sales", "y_true"), fresh_path(s.spark, "preds")
    )
    ddl = "store_nbr int, family string, date date, y_true double, y_pred double"
    return s.spark.read.schema(ddl).parquet(path)


@query(
    "a12_prices_template",
    "family:s price:f margin_rate:f holding_cost:f",
    """
SELECT DISTINCT family, 3.5 AS price, 0.25 AS margin_rate, 0.05 AS holding_cost FROM panel""",
)
def _(s):
    return raw.prices_template(s.panel)


