"""Keys, lists and other text handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_key(name: Column) -> Column:
    """File-safe name: odd runs become `_`, edge punctuation goes, empty becomes `family`."""
    runs = F.regexp_replace(name, r"[^0-9A-Za-z\-_.]+", "_")
    trimmed = F.regexp_replace(runs, r"^[._-]+|[._-]+$", "")
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("family"))


def model_key(store: Column, family: Column, quantile: Column | None = None) -> Column:
    """`store__Family_Name`, plus `__qNN` for a quantile model."""
    parts = [store.cast("string"), F.replace(family, F.lit(" "), F.lit("_"))]
    if quantile is not None:
        percent = F.round(quantile * 100).cast("int").cast("string")
        parts.append(F.concat(F.lit("q"), percent))
    return F.concat_ws("__", *parts)


def parse_model_key(key: Column) -> dict[str, Column]:
    """Inverse of `model_key`; store and quantile are NULL where they do not parse."""
    store = F.split_part(key, F.lit("__"), F.lit(1))
    rest = F.regexp_replace(key, r"^.*?__", "")
    percent = F.nullif(F.regexp_extract(key, r"__q(\d+)$", 1), F.lit(""))
    return {
        "key_store": store.try_cast("int"),
        "key_family": F.replace(
            F.regexp_replace(rest, r"__q\d+$", ""), F.lit("_"), F.lit(" ")
        ),
        "key_quantile": percent.try_cast("int") / F.lit(100.0),
    }


def parse_numbers(text: Column) -> Column:
    """`"0.5, 0.9"` to an array of doubles; entries that do not parse are dropped."""
    items = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    return F.filter(items, lambda x: x.isNotNull())


def parse_names(text: Column) -> Column:
    """Comma list to a set of trimmed, non-empty names."""
    items = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(items, lambda x: x != ""))
