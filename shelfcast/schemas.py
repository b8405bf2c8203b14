"""Explicit schemas of the retail tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PAIR = ["store_nbr", "family"]


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_int, _long, _dbl, _str = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_date, _bool = T.DateType(), T.BooleanType()

TRAIN = _schema(id=_long, date=_date, store_nbr=_int, family=_str, sales=_dbl, onpromotion=_dbl)
TRANSACTIONS = _schema(date=_date, store_nbr=_int, transactions=_dbl)
OIL = _schema(date=_date, dcoilwtico=_dbl)
HOLIDAYS = _schema(
    date=_date, type=_str, locale=_str, locale_name=_str, description=_str, transferred=_bool
)
STORES = _schema(store_nbr=_int, city=_str, state=_str, type=_str, cluster=_int)
PRICES = _schema(family=_str, price=_dbl, margin_rate=_dbl, holding_cost=_dbl, store_nbr=_int)

RAW_TABLES: dict[str, T.StructType] = {
    "train": TRAIN,
    "transactions": TRANSACTIONS,
    "oil": OIL,
    "holidays_events": HOLIDAYS,
    "stores": STORES,
}

# Columns an input file must have.
REQUIRED_COLUMNS: dict[str, list[str]] = {
    "train": ["date", "store_nbr", "family", "sales", "onpromotion"],
    "transactions": ["date", "store_nbr", "transactions"],
    "oil": ["date", "dcoilwtico"],
    "holidays_events": ["date", "type", "locale"],
    "stores": ["store_nbr", "city", "state", "type", "cluster"],
}

# Defaults when a pair has no price row.
DEFAULT_PRICE = 3.5
DEFAULT_MARGIN = 0.25
DEFAULT_HOLDING = 0.05
