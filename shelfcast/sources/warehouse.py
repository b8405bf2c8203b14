"""Parquet, CSV and JSON sinks, and views over the written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas

# Layout of the warehouse: hive partition columns per table.
PARTITIONING: dict[str, list[str]] = {
    "train": ["store_nbr", "family"],
    "transactions": ["store_nbr"],
    "oil": [],
    "holidays_events": [],
    "stores": [],
}


def write_parquet(
    df: DataFrame, root: str, name: str, partition_cols: list[str] | None = None
) -> str:
    """Replace `root/name`.

    With partition columns, rows are first spread by those columns and a few
    date salts: every partition folder gets a bounded number of files, and a
    pair that holds most of the rows is still written by several tasks.
    """
    path = f"{root}/{name}"
    writer_df = df
    if partition_cols:
        if "date" in df.columns:
            salt = F.pmod(F.year("date"), F.lit(8))
            writer_df = df.repartition(*[F.col(c) for c in partition_cols], salt)
        writer = writer_df.write.partitionBy(*partition_cols)
    else:
        writer = writer_df.write
    writer.mode("overwrite").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with the declared schema, so partition columns keep their types."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*schema.fieldNames())


def write_warehouse(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    return {
        name: write_parquet(df, root, name, PARTITIONING[name]) for name, df in tables.items()
    }


def register_views(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """One temporary view per warehouse table."""
    names = []
    for table, schema in schemas.RAW_TABLES.items():
        view = f"{prefix}{table}"
        read_parquet(spark, f"{root}/{table}", schema).createOrReplaceTempView(view)
        names.append(view)
    return names


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: list[str] = schemas.PAIR, order: str = "date", buckets: int = 64
) -> DataFrame:
    """Write `df` as the catalog table `table`, bucketed by `keys` and sorted inside each
    bucket, one file per bucket; returns the table.

    Windows and groups by `keys` then read it without an exchange, and windows in this order
    without a sort. A bucket holds whole pairs: meant for panels with a row per pair and day,
    where the calendar bounds a pair.
    """
    spread = df.repartition(buckets, *keys).sortWithinPartitions(*keys, order)
    writer = spread.write.bucketBy(buckets, *keys).sortBy(*keys, order)
    writer.option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def write_periods(df: DataFrame, path: str, period: str = "yyyy-MM") -> str:
    """Replace the periods (months, with the default pattern) that occur in `df`; files of
    all other periods stay as they are, so a day is corrected by writing its period anew."""
    dated = df.withColumn("period", F.date_format("date", period))
    (
        dated.repartition("period", F.pmod(F.xxhash64(*schemas.PAIR), F.lit(4)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period")
        .parquet(path)
    )
    return path


def write_raw_csv(tables: dict[str, DataFrame], folder: str) -> str:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
    return folder


def write_features(features: DataFrame, root: str) -> str:
    """Feature table with the target kept in the same rows."""
    return write_parquet(features.filter(F.col("sales").isNotNull()), root, "features")


def write_metrics(metrics: DataFrame, path: str) -> str:
    """Metric table as CSV, best MAE first over all files in the order of their names."""
    (
        metrics.orderBy("MAE", *schemas.PAIR)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
    return path


def write_predictions(predictions: DataFrame, path: str) -> str:
    """`(date, y_true, y_pred)` in one folder per pair."""
    (
        predictions.select(*schemas.PAIR, "date", "y_true", "y_pred")
        .repartition(*schemas.PAIR, F.pmod(F.year("date"), F.lit(8)))
        .write.mode("overwrite")
        .partitionBy(*schemas.PAIR)
        .parquet(path)
    )
    return path


def write_run_metadata(
    summary: DataFrame, params: dict[str, str], features: list[str], path: str
) -> str:
    """One JSON row: metric columns, parameters as a map, feature names as an array."""
    entries = [F.lit(x) for item in params.items() for x in item]
    (
        summary.withColumn("params", F.create_map(*entries))
        .withColumn("features", F.array(*[F.lit(f) for f in features]))
        .write.mode("overwrite")
        .json(path)
    )
    return path
