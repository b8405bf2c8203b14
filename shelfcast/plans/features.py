"""The feature table: calendar, dimensions, lags and rolling statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import panel as P
from shelfcast.operators.windows import Layout, Rolling, add_rolling
from shelfcast.sources.raw import order_exogenous

LAGS = (1, 7, 14, 28)
WINDOWS = (7, 30)

EXOGENOUS = [Rolling("transactions", (7,), WINDOWS), Rolling("oil_price", (7,), WINDOWS)]
PROMOTION = Rolling("onpromotion", LAGS, WINDOWS)
TARGET = Rolling("sales", LAGS, WINDOWS)


# Column order of the feature table.
FEATURE_COLUMNS: list[str] = [
    "id",
    "date",
    "store_nbr",
    "family",
    "sales",
    "onpromotion",
    "year",
    "month",
    "week",
    "day",
    "dayofweek",
    "quarter",
    "is_weekend",
    "is_month_start",
    "is_month_end",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "trend",
    "is_christmas",
    "is_newyear",
    "is_black_friday",
    "city",
    "state",
    "type",
    "cluster",
    "is_holiday_national",
    "is_holiday_regional",
    "is_holiday_local",
    "is_holiday",
    "transactions",
    "oil_price",
    "transactions_lag_7",
    "transactions_rollmean_7",
    "transactions_rollstd_7",
    "transactions_rollmean_30",
    "transactions_rollstd_30",
    "oil_price_lag_7",
    "oil_price_rollmean_7",
    "oil_price_rollstd_7",
    "oil_price_rollmean_30",
    "oil_price_rollstd_30",
    "onpromotion_lag_1",
    "onpromotion_lag_7",
    "onpromotion_lag_14",
    "onpromotion_lag_28",
    "onpromotion_rollmean_7",
    "onpromotion_rollstd_7",
    "onpromotion_rollmean_30",
    "onpromotion_rollstd_30",
    "days_from_prev_holiday",
    "days_to_next_holiday",
    "is_day_before_holiday",
    "is_day_after_holiday",
    "sales_lag_1",
    "sales_lag_7",
    "sales_lag_14",
    "sales_lag_28",
    "sales_rollmean_7",
    "sales_rollstd_7",
    "sales_rollmean_30",
    "sales_rollstd_30",
]

# Groups that the ablation table leaves out one at a time.
FEATURE_GROUPS: dict[str, list[str]] = {
    "calendar": [
        "year",
        "month",
        "week",
        "day",
        "dayofweek",
        "is_weekend",
        "is_month_start",
        "is_month_end",
        "dow_sin",
        "dow_cos",
        "month_sin",
        "month_cos",
        "trend",
    ],
    "special_days": [
        "is_christmas",
        "is_newyear",
        "is_black_friday",
    ],
    "holidays": [
        "is_holiday_national",
        "is_holiday_regional",
        "is_holiday_local",
        "is_holiday",
    ],
    "transactions": [
        "transactions",
    ],
    "oil": [
        "oil_price",
    ],
    "lags": [
        "sales_lag_1",
        "sales_lag_7",
        "sales_lag_14",
        "sales_lag_28",
    ],
    "rolls": [
        "sales_rollmean_7",
        "sales_rollstd_7",
        "sales_rollmean_30",
        "sales_rollstd_30",
    ],
    "store_meta": [
        "type",
        "city",
        "state",
        "cluster",
        "store_nbr",
        "family",
    ],
}

NOT_FEATURES = ("id", "sales", "date")


def add_dimensions(
    panel: DataFrame,
    holidays: DataFrame | None = None,
    transactions: DataFrame | None = None,
    oil: DataFrame | None = None,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Panel joined with every optional table; a missing one degrades to defaults."""
    days = P.store_days(panel, holidays, transactions, oil, stores)
    return _with_store_days(panel, days)


def _with_store_days(panel: DataFrame, days: DataFrame) -> DataFrame:
    return P.fill_promotion(panel.join(days, ["date", "store_nbr"], "left"))


def make_features(
    panel: DataFrame,
    holidays: DataFrame | None = None,
    transactions: DataFrame | None = None,
    oil: DataFrame | None = None,
    stores: DataFrame | None = None,
    target: str = "sales",
    add_lags: bool = True,
    drop_null_target: bool = False,
    layout: Layout | None = None,
    lags: tuple[int, ...] = LAGS,
    windows: tuple[int, ...] = WINDOWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Feature table of a daily panel.

    The panel is shuffled twice: by store and day for the one join that brings all
    dimensions, and by pair for all windows, which share one partitioning and order.
    Date columns come from a table with one row per day. `days` is the result of
    `store_days` for these tables, for callers who have written it beforehand.
    """
    holidays, transactions, oil = order_exogenous(holidays, transactions, oil)
    flags = days
    if days is None:
        days = P.store_days(panel, holidays, transactions, oil, stores)
        flags = P.store_days(panel, holidays, stores=stores)
    df = _with_store_days(panel, days)
    specs = [*EXOGENOUS, PROMOTION]
    if add_lags and target in panel.columns:
        specs.append(Rolling(target, tuple(lags), tuple(windows)))
    df = add_rolling(df, specs, layout)
    # one row per calendar day; the planner sees its size and chooses the join
    df = df.join(P.day_table(flags.select("date", "is_holiday")), "date", "left")
    if drop_null_target and target in df.columns:
        df = df.filter(F.col(target).isNotNull())
    first = [c for c in FEATURE_COLUMNS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def feature_columns(df: DataFrame, ordered: bool = False) -> list[str]:
    """Model inputs: everything but id, target and dates; `ordered` sorts by name."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    names = [
        f.name
        for f in df.schema
        if f.name not in NOT_FEATURES and not isinstance(f.dataType, temporal)
    ]
    return sorted(set(names)) if ordered else names


def numeric_features(df: DataFrame) -> list[str]:
    types = {f.name: f.dataType for f in df.schema}
    return [c for c in feature_columns(df) if isinstance(types[c], T.NumericType)]


def drop_feature_group(df: DataFrame, group: str) -> DataFrame:
    return df.drop(*FEATURE_GROUPS[group])
