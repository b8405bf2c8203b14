"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.base import query
from shelfcast.catalog.settings import FOLDS, STEP_DAYS, VALID_DAYS
from shelfcast.catalog.sql import lag_roll
from shelfcast.operators import evaluate as E
from shelfcast.operators import split as X
from shelfcast.operators import windows as W
from shelfcast.operators.windows import Layout, Rolling, add_rolling, rolled_columns
from shelfcast.plans import features as FT

KEY = "date:d store_nbr:i family:s"
LAGS, WINDOWS = FT.LAGS, FT.WINDOWS


def _cols(*specs: Rolling) -> str:
    return " ".join(f"{c}:f" for s in specs for c in rolled_columns(s))


def _rolled_sql(source: str, *specs: Rolling) -> str:
    parts = ", ".join(lag_roll(s.column, s.lags, s.windows) for s in specs)
    return f"SELECT date, store_nbr, family, {parts} FROM {source}"


TARGET_LAGS = Rolling("sales", LAGS)
TARGET_ROLLS = Rolling("sales", (), WINDOWS)


@query("e1_lags", f"{KEY} {_cols(TARGET_LAGS)}", _rolled_sql("panel", TARGET_LAGS))
def _(s):
    return add_rolling(s.panel, [TARGET_LAGS])


@query("e2_rolling", f"{KEY} {_cols(TARGET_ROLLS)}", _rolled_sql("panel", TARGET_ROLLS))
def _(s):
    return add_rolling(s.panel, [TARGET_ROLLS])


@query(
    "e2_rolling_blocks",
    f"{KEY} {_cols(FT.TARGET)}",
    _rolled_sql("panel", FT.TARGET),
)
def _(s):
    # small blocks, so every pair is really cut
    return add_rolling(s.panel, [FT.TARGET], Layout(block_rows=100))


@query("e3_exogenous", f"{KEY} {_cols(*FT.EXOGENOUS)}", _rolled_sql("dims", *FT.EXOGENOUS))
def _(s):
    return add_rolling(s.dims, FT.EXOGENOUS)


@query("e4_promotion", f"{KEY} {_cols(FT.PROMOTION)}", _rolled_sql("panel", FT.PROMOTION))
def _(s):
    return add_rolling(s.panel, [FT.PROMOTION])


def _carry_sql() -> str:
    frame = "OVER (ORDER BY store_nbr, family, date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    lags = ", ".join(
        f"LAG(sales, {k}) OVER (PARTITION BY store_nbr, family ORDER BY date) AS sales_lag_{k}"
        for k in LAGS
    )
    rolls = ", ".join(
        f"{fn}(shifted) {frame.format(n=n - 1)} AS sales_roll{name}_{n}"
        for n in WINDOWS
        for fn, name in (("AVG", "mean"), ("STDDEV_SAMP", "std"))
    )
    return f"""
SELECT *, {rolls} FROM (
  SELECT *, {lags},
         LAG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date) AS shifted FROM panel)"""


@query("e5_carry_over", f"{KEY} {_cols(FT.TARGET)}", _carry_sql())
def _(s):
    return add_rolling(s.stored_panel, [FT.TARGET], Layout(boundary="carry", block_rows=1000))


@query("e6_tail", f"{KEY} sales:f", "SELECT date, store_nbr, family, sales FROM tail_rows")
def _(s):
    return W.last_rows(s.panel, 30)


@query(
    "e7_holiday_calendar",
    "date:d days_from_prev_holiday:f days_to_next_holiday:f is_day_before_holiday:i"
    " is_day_after_holiday:i",
    "SELECT * FROM holiday_distance",
)
def _(s):
    from shelfcast.operators.panel import holiday_calendar

    return holiday_calendar(s.flagged)


@query(
    "e8_baselines",
    f"{KEY} sales:f naive_lag7:f naive_ma7:f",
    "SELECT date, store_nbr, family, sales, naive_lag7, naive_ma7 FROM split WHERE is_valid",
)
def _(s):
    return s.split.filter("is_valid")


@query(
    "e8_baselines_by_block",
    f"{KEY} sales:f naive_lag7:f naive_ma7:f",
    "SELECT date, store_nbr, family, sales, naive_lag7, naive_ma7 FROM split",
)
def _(s):
    return E.add_baselines(s.daily, block_rows=200)


@query(
    "e9_folds",
    "store_nbr:i family:s fold:i fold_start:d fold_end:d n_fold:l n_outside:l n_past:l",
    """
SELECT store_nbr, family, fold, ANY_VALUE(fold_start) AS fold_start, ANY_VALUE(fold_end) AS fold_end,
       COUNT(CASE WHEN in_fold THEN 1 END) AS n_fold,
       COUNT(CASE WHEN NOT in_fold THEN 1 END) AS n_outside,
       COUNT(CASE WHEN in_past THEN 1 END) AS n_past
FROM (SELECT r.*, w.fold_start, w.fold_end FROM fold_rows r
      JOIN fold_windows w USING (store_nbr, family, fold)) GROUP BY 1, 2, 3""",
)
def _(s):
    windows = X.fold_windows(s.panel, FOLDS, VALID_DAYS, STEP_DAYS)
    outside = X.expand_folds(s.panel, windows, "outside")
    past = F.col("date") < F.col("fold_start")
    return outside.groupBy("store_nbr", "family", "fold").agg(
        F.min("fold_start").alias("fold_start"),
        F.min("fold_end").alias("fold_end"),
        F.count_if("in_fold").alias("n_fold"),
        F.count_if("in_train").alias("n_outside"),
        F.count_if(past).alias("n_past"),
    )


@query("e10_strict_ma7", 'store_nbr:i family:s naive_MAPE_%:f', "SELECT * FROM strict_ma7")
def _(s):
    return E.strict_ma7_mape(s.panel, VALID_DAYS)


@query(
    "e11_sequences",
    f"{KEY} sales:f steps:i first_sales:f last_sales:f checksum:f",
    """
SELECT date, store_nbr, family, sales, n AS steps, first_sales, last_sales,
       placed - (rn - 31) * total AS checksum
FROM (SELECT *, COUNT(*) OVER w AS n, FIRST_VALUE(sales) OVER w AS first_sales,
             LAST_VALUE(sales) OVER w AS last_sales, SUM(v) OVER w AS total,
             SUM(v * rn) OVER w AS placed
      FROM (SELECT *, sales + 3 * onpromotion AS v,
                   ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY date) AS rn
            FROM panel)
      WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date
                   ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
WHERE n = 30""",
)
def _(s):
    df = W.add_sequences(s.panel, ["sales", "onpromotion"], 30)
    # each step weighs its place, so the order of the steps counts
    weighted = F.transform(
        "sequence", lambda v, i: (i + 1) * (F.element_at(v, 1) + 3 * F.element_at(v, 2))
    )
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v)
    return df.select(
        "date",
        "store_nbr",
        "family",
        "sales",
        F.size("sequence").alias("steps"),
        F.element_at(F.element_at("sequence", 1), 1).alias("first_sales"),
        F.element_at(F.element_at("sequence", -1), 1).alias("last_sales"),
        total.alias("checksum"),
    )


@query(
    "e12_scaling",
    f"{KEY} sales_scaled:f onpromotion_scaled:f",
    """
SELECT date, store_nbr, family, (sales - m1) / CASE WHEN d1 = 0 THEN 1 ELSE d1 END AS sales_scaled,
       (onpromotion - m2) / CASE WHEN d2 = 0 THEN 1 ELSE d2 END AS onpromotion_scaled
FROM split JOIN (SELECT store_nbr, family, AVG(sales) AS m1, STDDEV_POP(sales) AS d1,
                        AVG(onpromotion) AS m2, STDDEV_POP(onpromotion) AS d2
                 FROM split WHERE NOT is_valid GROUP BY 1, 2) USING (store_nbr, family)""",
)
def _(s):
    return W.scale_on_train(s.split, ["sales", "onpromotion"], ~F.col("is_valid"))


@query(
    "e13_latest_snapshot",
    f"{KEY} sales:f sales_lag_1:f sales_rollmean_7:f trend:i",
    """
SELECT * FROM (
  SELECT date, store_nbr, family, sales, trend,
         LAG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date) AS sales_lag_1,
         AVG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date
                          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sales_rollmean_7,
         ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY date DESC) AS rn
  FROM daily) WHERE rn = 1""",
)
def _(s):
    return W.latest_snapshot(s.features)


@query(
    "e14_pair_bounds",
    f"{KEY} first_date:d last_date:d",
    """
SELECT date, store_nbr, family, MIN(date) OVER (PARTITION BY store_nbr, family) AS first_date,
       MAX(date) OVER (PARTITION BY store_nbr, family) AS last_date FROM panel""",
)
def _(s):
    return W.pair_bounds(s.stored_panel)


_TYPES = {"id": "l", "date": "d", "family": "s", "city": "s", "state": "s", "type": "s"}
_INTS = {
    "store_nbr",
    "cluster",
    "trend",
    "year",
    "month",
    "week",
    "day",
    "dayofweek",
    "quarter",
    "is_weekend",
    "is_month_start",
    "is_month_end",
    *FT.FEATURE_GROUPS["special_days"],
    *FT.FEATURE_GROUPS["holidays"],
}
_INTS |= {"is_day_before_holiday", "is_day_after_holiday"}
FEATURE_TYPES = " ".join(
    f"{c}:{_TYPES.get(c, 'i' if c in _INTS else 'f')}" for c in FT.FEATURE_COLUMNS
)


@query("features_table", FEATURE_TYPES, "SELECT * FROM feature_rows")
def _(s):
    return s.features
