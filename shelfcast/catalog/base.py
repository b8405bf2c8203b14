"""Registration of queries and of their SQL twins.

A query states its output once, as `name:type` items. Both sides end in the same
projection: dates as ISO text, and doubles rounded to six digits by plain
arithmetic, which absorbs the order of summation.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.catalog.sql import CTES
from shelfcast.catalog.study import Study

SQL_TYPES = {"i": "INTEGER", "l": "BIGINT", "s": "VARCHAR", "d": "VARCHAR", "b": "BOOLEAN"}
SPARK_TYPES = {"i": "int", "l": "bigint", "s": "string", "d": "string", "b": "boolean"}


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _items(columns: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in columns.split()]


def present(df: DataFrame, columns: str) -> DataFrame:
    out: list[Column] = []
    for name, kind in _items(columns):
        c = F.col(f"`{name}`")
        if kind == "f":
            c = F.floor(c.cast("double") * 1e6 + 0.5).cast("double") / 1e6
        else:
            c = c.cast(SPARK_TYPES[kind])
        out.append(c.alias(name))
    return df.select(*out)


def _sql_column(name: str, kind: str) -> str:
    quoted = f'"{name}"'
    if kind == "f":
        return f"CAST(FLOOR(CAST({quoted} AS DOUBLE) * 1e6 + 0.5) AS DOUBLE) / 1e6 AS {quoted}"
    return f"CAST({quoted} AS {SQL_TYPES[kind]}) AS {quoted}"


def _needed(body: str, wanted: set[str]) -> set[str]:
    for name, text in CTES.items():
        if name not in wanted and re.search(rf"\b{name}\b", body):
            wanted.add(name)
            _needed(text, wanted)
    return wanted


def full_sql(body: str, columns: str) -> str:
    wanted = _needed(body, set())
    parts = [f"{n} AS ({text.strip()})" for n, text in CTES.items() if n in wanted]
    parts.append(f"answer AS ({body.strip()})")
    select = ", ".join(_sql_column(n, k) for n, k in _items(columns))
    return "WITH " + ",\n".join(parts) + f"\nSELECT {select} FROM answer"


def query(name: str, columns: str, sql: str | None = None):
    """Register `fn(study) -> DataFrame` under `name`."""

    def register(fn: Callable[[Study], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return present(fn(Study(spark, folder)), columns)

        QUERIES[name] = Query(name, run, None if sql is None else full_sql(sql, columns))
        return fn

    return register
