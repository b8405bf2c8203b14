"""Raw CSV folder: reading, validation, fallback, templates."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.session import path_exists


def csv_path(folder: str, table: str) -> str:
    return f"{folder}/{table}.csv"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV; only the header line is read."""
    return spark.read.option("header", True).csv(path).columns


def read_raw_table(
    spark: SparkSession,
    folder: str,
    table: str,
    columns: list[str] | None = None,
    nrows: int | None = None,
) -> DataFrame:
    """One raw table with its declared types; columns absent from the file are left out."""
    path = csv_path(folder, table)
    known = {f.name: f.dataType.simpleString() for f in schemas.RAW_TABLES[table]}
    header = csv_header(spark, path)
    ddl = ", ".join(f"`{c}` {known.get(c, 'string')}" for c in header)
    df = spark.read.option("header", True).schema(ddl).csv(path)
    if columns:
        df = df.select(*columns)
    return df.limit(nrows) if nrows else df


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: read_raw_table(spark, folder, t) for t in schemas.RAW_TABLES}


def validate_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per input file: status OK, BAD COLS, MISSING or ERROR, and missing columns."""
    rows = []
    for table, required in schemas.REQUIRED_COLUMNS.items():
        path = csv_path(folder, table)
        if not path_exists(spark, path):
            rows.append((f"{table}.csv", required, [], "MISSING"))
            continue
        try:
            rows.append((f"{table}.csv", required, csv_header(spark, path), "READ"))
        except Exception:  # noqa: BLE001 - any unreadable file is a report row
            rows.append((f"{table}.csv", required, [], "ERROR"))
    seen = spark.createDataFrame(
        rows, "file string, required array<string>, actual array<string>, state string"
    )
    missing = F.array_sort(F.array_except("required", "actual"))
    return seen.select(
        "file",
        F.when(F.col("state") != "READ", F.col("state"))
        .when(F.size(missing) > 0, F.lit("BAD COLS"))
        .otherwise(F.lit("OK"))
        .alias("status"),
        missing.alias("missing"),
    )


def inputs_valid(report: DataFrame) -> bool:
    return report.filter(F.col("status") != "OK").isEmpty()


def read_sales(spark: SparkSession, features_path: str, raw_folder: str) -> DataFrame:
    """The feature table when it was written, else the raw sales file."""
    if path_exists(spark, features_path):
        return spark.read.parquet(features_path)
    if path_exists(spark, csv_path(raw_folder, "train")):
        return read_raw_table(spark, raw_folder, "train")
    raise FileNotFoundError(f"neither {features_path} nor {csv_path(raw_folder, 'train')}")


def prices_template(
    train: DataFrame,
    price: float = schemas.DEFAULT_PRICE,
    margin_rate: float = schemas.DEFAULT_MARGIN,
    holding_cost: float = schemas.DEFAULT_HOLDING,
) -> DataFrame:
    """One default price row per family."""
    return (
        train.select("family")
        .filter(F.col("family").isNotNull())
        .distinct()
        .select(
            "family",
            F.lit(price).alias("price"),
            F.lit(margin_rate).alias("margin_rate"),
            F.lit(holding_cost).alias("holding_cost"),
        )
        .orderBy("family")
    )


# Columns that mark the role of an optional table.
ROLE_MARKERS: dict[str, list[str]] = {
    "holidays": ["locale", "type", "transferred"],
    "transactions": ["transactions"],
    "oil": ["dcoilwtico", "oil_price"],
}


def order_exogenous(
    holidays: DataFrame | None, transactions: DataFrame | None, oil: DataFrame | None
) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """The three tables in the order of their roles, whatever the order they came in.

    Tables that all carry a marker of the role they were given for stay there, and so do
    incomplete sets. Else the one assignment under which every table has a marker is taken;
    several possible ones are an error, none leaves the tables as given.
    """
    given = [holidays, transactions, oil]
    if any(t is None for t in given):
        return holidays, transactions, oil

    def fits(tables) -> bool:
        marks = ROLE_MARKERS.values()
        return all(not set(m).isdisjoint(t.columns) for m, t in zip(marks, tables))

    if fits(given):
        return holidays, transactions, oil
    found = [order for order in permutations(given) if fits(order)]
    if len(found) > 1:
        raise ValueError("the roles of the optional tables are ambiguous")
    return found[0] if found else (holidays, transactions, oil)
