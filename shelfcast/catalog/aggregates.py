"""Aggregations, resampling and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.base import query
from shelfcast.catalog.settings import FOLDS, RECENT_DAYS, STEP_DAYS, VALID_DAYS
from shelfcast.catalog.sql import ape, mae_mape
from shelfcast.functions import metrics as M
from shelfcast.operators import evaluate as E
from shelfcast.operators import resample as R
from shelfcast.operators import select as S
from shelfcast.plans import compare, models, money, reports
from shelfcast.schemas import PAIR

PAIR_COLS = "store_nbr:i family:s"


@query("d1_top_pairs", f"{PAIR_COLS} sales:f", "SELECT * FROM top20")
def _(s):
    return S.top_pairs(s.panel, 20, RECENT_DAYS)


@query(
    "d1_best_pair",
    f"{PAIR_COLS} sales:f",
    """
SELECT store_nbr, family, SUM(sales) AS sales FROM panel GROUP BY 1, 2
ORDER BY sales DESC, store_nbr, family LIMIT 1""",
)
def _(s):
    return S.top_pairs(s.panel, 1)


@query(
    "d2_by_store",
    "store_nbr:i MAE:f MAPE_%:f",
    'SELECT store_nbr, AVG("MAE") AS "MAE", AVG("MAPE_%") AS "MAPE_%" FROM metrics GROUP BY 1',
)
def _(s):
    return reports.mean_by(s.metrics, "store_nbr")


@query(
    "d3_by_family",
    "family:s MAE:f MAPE_%:f",
    'SELECT family, AVG("MAE") AS "MAE", AVG("MAPE_%") AS "MAPE_%" FROM metrics GROUP BY 1',
)
def _(s):
    return reports.mean_by(s.metrics, "family")


@query(
    "d4_metric_summary",
    "models:l mean_MAE:f mean_MAPE:f mean_CV_MAE:f mean_CV_MAPE:f",
    """
SELECT COUNT(*) AS models, AVG("MAE") AS "mean_MAE", AVG("MAPE_%") AS "mean_MAPE",
       AVG("CV_MAE") AS "mean_CV_MAE", AVG("CV_MAPE_%") AS "mean_CV_MAPE" FROM metrics""",
)
def _(s):
    return reports.metric_summary(s.metrics)


@query(
    "d5_model_summary",
    "model:s MAE:f MAPE:f size_hint:s",
    """
SELECT 'trend per pair' AS model, AVG("MAE") AS "MAE", AVG("MAPE_%") AS "MAPE",
       'row per pair' AS size_hint FROM metrics
UNION ALL SELECT 'lag 7', AVG("NAIVE_LAG7_MAE"), AVG("NAIVE_LAG7_MAPE_%"), 'none' FROM metrics
UNION ALL SELECT 'moving average 7', AVG("NAIVE_MA7_MAE"), AVG("NAIVE_MA7_MAPE_%"), 'none'
FROM metrics""",
)
def _(s):
    models_ = {"trend per pair": ("y_pred", "row per pair"), "lag 7": ("naive_lag7", "none")}
    models_["moving average 7"] = ("naive_ma7", "none")
    return compare.holdout_summary(s.held, models_)


@query("d6_holiday_days", "date:d h:i", "SELECT * FROM holiday_days")
def _(s):
    return s.flagged.groupBy("date").agg(F.max("is_holiday").alias("h"))


@query(
    "d7_tail_totals",
    f"{PAIR_COLS} N:l SUM_Y:f",
    'SELECT store_nbr, family, COUNT(sales) AS "N", SUM(sales) AS "SUM_Y" FROM recent_valid GROUP BY 1, 2',
)
def _(s):
    return E.tail_totals(S.recent(s.panel, VALID_DAYS))


@query(
    "d8_daily_rollup",
    "store_nbr:i date:d sales:f transactions:f",
    """
SELECT store_nbr, date, SUM(sales) AS sales, MAX(transactions) AS transactions
FROM panel JOIN transactions USING (store_nbr, date) GROUP BY 1, 2""",
)
def _(s):
    sales = R.daily_sales(s.panel).groupBy("store_nbr", "date").agg(F.sum("sales").alias("sales"))
    return sales.join(R.daily_transactions(s.transactions), ["store_nbr", "date"])


_PROFILE = """SELECT '{n}' AS dimension, {v} AS value, AVG(sales) AS mean_sales, COUNT(sales) AS n,
       AVG(sales) - 1.96 * STDDEV_SAMP(sales) / SQRT(COUNT(sales)) AS ci_low,
       AVG(sales) + 1.96 * STDDEV_SAMP(sales) / SQRT(COUNT(sales)) AS ci_high
FROM panel GROUP BY 2"""


@query(
    "d9_sales_profiles",
    "dimension:s value:i mean_sales:f n:l ci_low:f ci_high:f",
    " UNION ALL ".join(
        _PROFILE.format(n=n, v=v)
        for n, v in [
            ("dayofweek", "isodow(date) - 1"),
            ("month", "month(date)"),
            ("promo", "CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END"),
        ]
    ),
)
def _(s):
    return R.sales_profiles(s.panel)


def _bootstrap_sql(replicates: int) -> str:
    steps = " + ".join(f"CASE WHEN u >= {p} THEN 1.0 ELSE 0.0 END" for p in R.POISSON_ONE)
    dims = "['dayofweek', 'month', 'promo']"
    values = "[isodow(date) - 1, month(date), CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END]"
    return f"""
SELECT dimension, value, mean_sales, n, QUANTILE_CONT(m, 0.025) AS ci_low, QUANTILE_CONT(m, 0.975) AS ci_high
FROM (SELECT dimension, value, SUM(w * sales) / SUM(w) AS m
      FROM (SELECT dimension, value, sales, k, {steps} AS w
            FROM (SELECT UNNEST({dims}) AS dimension, UNNEST({values}) AS value, sales, id, k,
                         CAST('0x' || SUBSTR(MD5(CAST(id AS VARCHAR) || '-' || CAST(k // 4 AS VARCHAR)), 1 + k % 4 * 8, 8)
                              AS BIGINT) / 4294967296.0::DOUBLE AS u
                  FROM panel, (SELECT CAST(UNNEST(RANGE({replicates})) AS INTEGER) AS k)))
      GROUP BY dimension, value, k)
JOIN (SELECT dimension, value, AVG(sales) AS mean_sales, COUNT(sales) AS n
      FROM (SELECT UNNEST({dims}) AS dimension, UNNEST({values}) AS value, sales FROM panel)
      GROUP BY 1, 2) USING (dimension, value)
GROUP BY 1, 2, 3, 4"""


@query(
    "d9_bootstrap_profiles",
    "dimension:s value:i mean_sales:f n:l ci_low:f ci_high:f",
    _bootstrap_sql(20),
)
def _(s):
    return R.bootstrap_profiles(s.stored_panel, 20)


@query(
    "d10_conditional_totals",
    "pairs:l pairs_with_model:l pairs_without_model:l savings_under:f savings_over_per_day:f",
    """
SELECT COUNT(*) AS pairs, COUNT("model_MAPE_%") AS pairs_with_model,
       COUNT(*) - COUNT("model_MAPE_%") AS pairs_without_model,
       COALESCE(SUM(CASE WHEN "model_MAPE_%" IS NOT NULL THEN savings_under END), 0)
         AS savings_under,
       COALESCE(SUM(CASE WHEN "model_MAPE_%" IS NOT NULL THEN savings_over_per_day END), 0)
         AS savings_over_per_day
FROM impact""",
)
def _(s):
    return money.impact_summary(
        money.impact_report(s.stored_panel, s.metrics, s.prices, valid_days=VALID_DAYS)
    )


@query(
    "d11_mae",
    f"{PAIR_COLS} MAE:f",
    'SELECT store_nbr, family, AVG(ABS(sales - y_pred)) AS "MAE" FROM held GROUP BY 1, 2',
)
def _(s):
    return E.error_metrics(s.held, {"": "y_pred"})


@query(
    "d12_mape",
    f"{PAIR_COLS} MAPE_%:f promo_MAPE_%:f",
    f"""
SELECT store_nbr, family, AVG({ape("sales", "y_pred")}) * 100 AS "MAPE_%",
       AVG({ape("onpromotion", "1")}) * 100 AS "promo_MAPE_%"
FROM held GROUP BY 1, 2""",
)
def _(s):
    # onpromotion holds zeros, the case of the guarded denominator
    one = F.lit(1.0)
    return s.held.groupBy(*PAIR).agg(
        M.mape(F.col("sales"), F.col("y_pred")).alias("MAPE_%"),
        M.mape(F.col("onpromotion"), one).alias("promo_MAPE_%"),
    )


@query("d13_wmape", f"{PAIR_COLS} wMAPE_%_est:f", "SELECT * FROM board")
def _(s):
    return E.add_wmape(s.metrics, E.tail_totals(S.recent(s.stored_panel, VALID_DAYS)))


_BAND = """
SELECT h.store_nbr, h.family, h.date, h.sales, h.y_pred + a.shift AS p50, h.y_pred + b.shift AS p90
FROM held h JOIN residual_shift a ON h.store_nbr = a.store_nbr AND h.family = a.family AND a.quantile = 0.5
            JOIN residual_shift b ON h.store_nbr = b.store_nbr AND h.family = b.family AND b.quantile = 0.9"""


def band(s):
    """Holdout rows with their 0.5 and 0.9 forecasts."""
    shifts = models.residual_quantiles(s.split, s.fit, ~F.col("is_valid"))
    wide = shifts.groupBy(*PAIR).agg(
        F.max(F.when(F.col("quantile") == 0.5, F.col("shift"))).alias("s50"),
        F.max(F.when(F.col("quantile") == 0.9, F.col("shift"))).alias("s90"),
    )
    return s.held.join(wide, PAIR).withColumns(
        {"p50": F.col("y_pred") + F.col("s50"), "p90": F.col("y_pred") + F.col("s90")}
    )


@query(
    "d14_interval_coverage",
    f"{PAIR_COLS} coverage:f avg_width:f",
    f"""
SELECT store_nbr, family, AVG(ABS(p90 - p50)) AS avg_width,
       AVG(CASE WHEN sales BETWEEN LEAST(p50, p90) AND GREATEST(p50, p90) THEN 1.0 ELSE 0.0 END)
         AS coverage
FROM ({_BAND}) GROUP BY 1, 2""",
)
def _(s):
    return E.coverage_metrics(band(s), "p50", "p90")


@query(
    "d15_gains",
    f"{PAIR_COLS} MAE_GAIN_vs_LAG7:f MAE_GAIN_vs_MA7:f",
    "SELECT * FROM metrics",
)
def _(s):
    return s.metrics


@query(
    "d16_fold_means",
    f"{PAIR_COLS} CV_MAE:f CV_MAPE_%:f",
    """
SELECT store_nbr, family, AVG("MAE") AS "CV_MAE", AVG("MAPE_%") AS "CV_MAPE_%"
FROM fold_metrics GROUP BY 1, 2""",
)
def _(s):
    folds = models.trend_cross_validation(s.daily, FOLDS, VALID_DAYS, STEP_DAYS)
    return models.mean_over_folds(folds)


@query(
    "d17_gain_heatmap",
    "store_nbr:i family:s gain:f",
    """
SELECT s.store_nbr, f.family, COALESCE(g.gain, 0) AS gain
FROM (SELECT DISTINCT store_nbr FROM metrics) s
CROSS JOIN (SELECT DISTINCT p_type AS family FROM part) f
LEFT JOIN (SELECT store_nbr, family, AVG("MAE_GAIN_vs_LAG7") AS gain FROM metrics GROUP BY 1, 2) g
  ON s.store_nbr = g.store_nbr AND f.family = g.family""",
)
def _(s):
    stores = s.metrics.select("store_nbr").distinct()
    families = s.table("part").select(F.col("p_type").alias("family")).distinct()
    return R.gain_cells(s.metrics, stores, families, "MAE_GAIN_vs_LAG7")


def _resample_sql(label: str, spine: str, how: str) -> str:
    value = "COALESCE(b.v, 0)" if how == "SUM" else "b.v"
    return f"""
SELECT sp.store_nbr, sp.family, sp.bin, {value} AS sales
FROM (SELECT store_nbr, family, UNNEST({spine}) AS bin
      FROM (SELECT store_nbr, family, MIN({label}) AS lo, MAX({label}) AS hi FROM panel
            GROUP BY 1, 2)) sp
LEFT JOIN (SELECT store_nbr, family, {label} AS bin, {how}(sales) AS v FROM panel
           GROUP BY 1, 2, 3) b
  ON sp.store_nbr = b.store_nbr AND sp.family = b.family AND CAST(sp.bin AS DATE) = b.bin"""


_WEEK = "CAST(DATE_TRUNC('week', date) AS DATE) + 6"
_WEEKS = "[CAST(x AS DATE) FOR x IN GENERATE_SERIES(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)]"
_MONTH = "LAST_DAY(date)"
_MONTHS = (
    "[LAST_DAY(CAST(x AS DATE)) FOR x IN GENERATE_SERIES(DATE_TRUNC('month', CAST(lo AS TIMESTAMP)),"
    " DATE_TRUNC('month', CAST(hi AS TIMESTAMP)), INTERVAL 1 MONTH)]"
)
BINS = f"{PAIR_COLS} bin:d sales:f"


@query("d18_resample_week_sum", BINS, _resample_sql(_WEEK, _WEEKS, "SUM"))
def _(s):
    return R.resample(s.panel, ["sales"], "W", "sum", PAIR)


@query("d18_resample_week_mean", BINS, _resample_sql(_WEEK, _WEEKS, "AVG"))
def _(s):
    return R.resample(s.panel, ["sales"], "W", "mean", PAIR)


@query("d18_resample_month_sum", BINS, _resample_sql(_MONTH, _MONTHS, "SUM"))
def _(s):
    return R.resample(s.panel, ["sales"], "M", "sum", PAIR)


def _resampled_errors_sql(label: str, spine: str) -> str:
    """Errors of binned sums; a bin without rows is 0 against 0 and counts."""
    return f"""
SELECT store_nbr, family, {mae_mape("y", "p")}
FROM (SELECT sp.store_nbr, sp.family, COALESCE(b.y, 0) AS y, COALESCE(b.p, 0) AS p
      FROM (SELECT store_nbr, family, UNNEST({spine}) AS bin
            FROM (SELECT store_nbr, family, MIN({label}) AS lo, MAX({label}) AS hi FROM held
                  GROUP BY 1, 2)) sp
      LEFT JOIN (SELECT store_nbr, family, {label} AS bin, SUM(sales) AS y, SUM(y_pred) AS p
                 FROM held GROUP BY 1, 2, 3) b
        ON sp.store_nbr = b.store_nbr AND sp.family = b.family AND CAST(sp.bin AS DATE) = b.bin)
GROUP BY 1, 2"""


@query(
    "d19_resampled_errors",
    f"{PAIR_COLS} MAE:f MAPE_%:f",
    _resampled_errors_sql(_MONTH, _MONTHS),
)
def _(s):
    return compare.resampled_errors(s.held, "M")


@query(
    "d19_resampled_errors_week",
    f"{PAIR_COLS} MAE:f MAPE_%:f",
    _resampled_errors_sql(_WEEK, _WEEKS),
)
def _(s):
    return compare.resampled_errors(s.held, "W")


@query(
    "d20_ticket_items",
    "ticket:l family:s qty:l",
    """
SELECT l_orderkey AS ticket, p_type AS family, COUNT(*) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def _(s):
    parts = s.table("part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("family")
    )
    lines = s.table("lineitem").join(parts, "l_partkey")
    return R.ticket_items(lines, "l_orderkey").withColumnRenamed("l_orderkey", "ticket")


@query(
    "d21_impute_transactions",
    "store_nbr:i date:d units:f n_tickets:i",
    """
SELECT store_nbr, date, units,
       LEAST(GREATEST(CASE WHEN tx > 0 THEN tx
                           ELSE GREATEST(1, CAST(FLOOR(FLOOR(units) / 1.4) AS INTEGER)) END, 5), 40)
         AS n_tickets
FROM (SELECT p.store_nbr, p.date, SUM(p.sales) AS units, MAX(t.transactions) AS tx
      FROM panel p LEFT JOIN (SELECT * FROM transactions WHERE transactions >= 3) t
        ON p.store_nbr = t.store_nbr AND p.date = t.date GROUP BY 1, 2)""",
)
def _(s):
    # days with one or two tickets count as unknown, to have something to estimate
    known = s.transactions.filter("transactions >= 3")
    return R.impute_transactions(R.sales_with_transactions(s.panel, known), 5, 40)


@query(
    "d22_distinct_pairs",
    f"{PAIR_COLS}",
    "SELECT DISTINCT store_nbr, family FROM panel",
)
def _(s):
    return s.panel.select(*PAIR).distinct()


@query(
    "d21_impute_all",
    "store_nbr:i date:d units:f n_tickets:i",
    """
SELECT p.store_nbr, p.date, SUM(p.sales) AS units,
       CAST(LEAST(GREATEST(MAX(t.transactions), 2), 30) AS INTEGER) AS n_tickets
FROM panel p JOIN transactions t ON p.store_nbr = t.store_nbr AND p.date = t.date GROUP BY 1, 2""",
)
def _(s):
    return R.impute_transactions(R.sales_with_transactions(s.panel, s.transactions), 2, 30)
