"""Common table expressions shared by the SQL twins, in dependency order."""

from __future__ import annotations

from shelfcast.catalog.settings import FOLDS, RECENT_DAYS, VALID_DAYS
from shelfcast.plans.features import EXOGENOUS, PROMOTION, TARGET

_PAIR = "PARTITION BY store_nbr, family"


def lag_roll(column: str, lags: tuple[int, ...], windows: tuple[int, ...]) -> str:
    """Lag and rolling columns over the named window `w`."""
    frame = f"OVER ({_PAIR} ORDER BY date ROWS BETWEEN {{n}} PRECEDING AND 1 PRECEDING)"
    parts = [f"LAG({column}, {k}) OVER ({_PAIR} ORDER BY date) AS {column}_lag_{k}" for k in lags]
    for n in windows:
        over = frame.format(n=n)
        parts.append(f"AVG({column}) {over} AS {column}_rollmean_{n}")
        parts.append(f"STDDEV_SAMP({column}) {over} AS {column}_rollstd_{n}")
    return ", ".join(parts)


def ape(y: str, p: str) -> str:
    return f"ABS(({y} - {p}) / CASE WHEN {y} = 0 THEN 1 ELSE {y} END)"


def mae_mape(y: str, p: str, prefix: str = "") -> str:
    return f'AVG(ABS({y} - {p})) AS "{prefix}MAE", AVG({ape(y, p)}) * 100 AS "{prefix}MAPE_%"'


def _features_sql() -> str:
    specs = ", ".join(
        lag_roll(c.column, c.lags, c.windows) for c in [*EXOGENOUS, PROMOTION, TARGET]
    )
    return f"""
SELECT d.*, year(d.date) AS year, month(d.date) AS month, weekofyear(d.date) AS week,
       day(d.date) AS day, isodow(d.date) - 1 AS dayofweek, quarter(d.date) AS quarter,
       CASE WHEN isodow(d.date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN day(d.date) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN d.date = last_day(d.date) THEN 1 ELSE 0 END AS is_month_end,
       SIN(2 * PI() * (isodow(d.date) - 1) / 7) AS dow_sin,
       COS(2 * PI() * (isodow(d.date) - 1) / 7) AS dow_cos,
       SIN(2 * PI() * (month(d.date) - 1) / 12) AS month_sin,
       COS(2 * PI() * (month(d.date) - 1) / 12) AS month_cos,
       d.date - (SELECT MIN(date) FROM panel) AS trend,
       CASE WHEN month(d.date) = 12 AND day(d.date) = 25 THEN 1 ELSE 0 END AS is_christmas,
       CASE WHEN month(d.date) = 1 AND day(d.date) = 1 THEN 1 ELSE 0 END AS is_newyear,
       CASE WHEN month(d.date) = 11 AND isodow(d.date) = 5 AND day(d.date) BETWEEN 23 AND 29
            THEN 1 ELSE 0 END AS is_black_friday,
       h.days_from_prev_holiday, h.days_to_next_holiday, h.is_day_before_holiday,
       h.is_day_after_holiday
FROM (SELECT *, {specs} FROM dims) d LEFT JOIN holiday_distance h ON d.date = h.date"""


def ridge_two(source: str, train: str, keys: str, alpha: float = 1.0) -> str:
    """Closed form of a ridge regression of sales on onpromotion and trend, standardised:
    (keys, setting, w1, w2, b), with both inputs, without the first, without the second."""
    live = "s{i} > 1e-9 * GREATEST(1, ABS(m{i})) AND k{i}"
    return f"""
SELECT {keys}, setting, w1, w2, my - w1 * m1 - w2 * m2 AS b
FROM (SELECT *,
    CASE WHEN l1 AND l2 THEN ((1 + a) * c1 - r * c2) / ((1 + a) * (1 + a) - r * r) / s1
         WHEN l1 THEN c1 / (1 + a) / s1 ELSE 0 END AS w1,
    CASE WHEN l1 AND l2 THEN ((1 + a) * c2 - r * c1) / ((1 + a) * (1 + a) - r * r) / s2
         WHEN l2 THEN c2 / (1 + a) / s2 ELSE 0 END AS w2
  FROM (SELECT *, {alpha} / n AS a, c12 / NULLIF(s1 * s2, 0) AS r, c1y / NULLIF(s1, 0) AS c1,
               c2y / NULLIF(s2, 0) AS c2, {live.format(i=1)} AS l1, {live.format(i=2)} AS l2
        FROM (SELECT {keys}, COUNT(*) AS n, AVG(onpromotion) AS m1, AVG(trend) AS m2,
                     AVG(sales) AS my, STDDEV_POP(onpromotion) AS s1, STDDEV_POP(trend) AS s2,
                     COVAR_POP(onpromotion, trend) AS c12, COVAR_POP(onpromotion, sales) AS c1y,
                     COVAR_POP(trend, sales) AS c2y
              FROM {source} WHERE {train} GROUP BY {keys}),
             (VALUES ('full', TRUE, TRUE), ('w/o promo', FALSE, TRUE), ('w/o trend', TRUE, FALSE))
               AS masks(setting, k1, k2)))"""


CTES: dict[str, str] = {
    "panel": """
SELECT MIN(l.l_orderkey * 10 + l.l_linenumber) AS id, CAST(l.l_shipdate AS DATE) AS date,
       s.s_nationkey AS store_nbr, p.p_type AS family,
       CAST(SUM(l.l_quantity) AS DOUBLE) AS sales,
       CAST(SUM(CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END) AS DOUBLE) AS onpromotion
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 2, 3, 4""",
    "transactions": """
SELECT CAST(l.l_shipdate AS DATE) AS date, s.s_nationkey AS store_nbr,
       CAST(COUNT(DISTINCT l.l_orderkey) AS DOUBLE) AS transactions
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2""",
    "stores": """
SELECT n_nationkey AS store_nbr, n_name AS city, r_name AS state,
       SUBSTR('ABCDE', CAST(n_nationkey % 5 AS INT) + 1, 1) AS type,
       CAST(n_nationkey % 17 + 1 AS INT) AS cluster
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "oil": """
SELECT CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS dcoilwtico
FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) <= 5 GROUP BY 1""",
    "prices": """
SELECT p_type AS family, ROUND(AVG(p_retailprice) / 100, 4) AS price,
       CAST(0.25 AS DOUBLE) AS margin_rate, CAST(0.05 AS DOUBLE) AS holding_cost
FROM part GROUP BY 1""",
    "days": """
SELECT date, EXTRACT(YEAR FROM date) AS y, EXTRACT(MONTH FROM date) AS m,
       EXTRACT(DAY FROM date) AS dd
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
    "holidays_events": """
SELECT date, 'Holiday' AS type, 'National' AS locale, 'ALL' AS locale_name,
       'n' AS description, (m = 5 AND y % 4 = 0) AS transferred
FROM days CROSS JOIN (SELECT r_regionkey FROM region WHERE r_regionkey < 2) twice
WHERE (dd = 1 AND m IN (1, 5, 12)) OR (dd = 25 AND m = 12)
UNION ALL
SELECT date, 'Holiday', 'Regional', r_name, 'r', FALSE
FROM days JOIN region ON dd = 10 AND m = r_regionkey + 2
UNION ALL
SELECT date, 'Event', 'Local', n_name, 'l', FALSE
FROM days JOIN nation ON m = n_nationkey % 12 + 1 AND dd = n_nationkey % 28 + 1""",
    "live_holidays": """
SELECT DISTINCT date, LOWER(locale) AS locale, locale_name
FROM holidays_events WHERE NOT transferred""",
    "flagged": """
SELECT p.*, st.city, st.state, st.type, st.cluster,
       CASE WHEN n.date IS NULL THEN 0 ELSE 1 END AS is_holiday_national,
       CASE WHEN r.date IS NULL THEN 0 ELSE 1 END AS is_holiday_regional,
       CASE WHEN l.date IS NULL THEN 0 ELSE 1 END AS is_holiday_local,
       CASE WHEN n.date IS NULL AND r.date IS NULL AND l.date IS NULL THEN 0 ELSE 1 END
         AS is_holiday
FROM panel p
LEFT JOIN stores st ON p.store_nbr = st.store_nbr
LEFT JOIN (SELECT DISTINCT date FROM live_holidays WHERE locale = 'national') n
       ON p.date = n.date
LEFT JOIN (SELECT date, locale_name FROM live_holidays WHERE locale = 'regional') r
       ON p.date = r.date AND st.state = r.locale_name
LEFT JOIN (SELECT date, locale_name FROM live_holidays WHERE locale = 'local') l
       ON p.date = l.date AND st.city = l.locale_name""",
    "dims": """
SELECT f.*, t.transactions, o.dcoilwtico AS oil_price
FROM flagged f
LEFT JOIN transactions t ON f.date = t.date AND f.store_nbr = t.store_nbr
LEFT JOIN oil o ON f.date = o.date""",
    "holiday_days": """
SELECT date, MAX(is_holiday) AS h FROM flagged GROUP BY 1""",
    "holiday_distance": """
SELECT date, CAST(date - prev AS DOUBLE) AS days_from_prev_holiday,
       CAST(nxt - date AS DOUBLE) AS days_to_next_holiday,
       CASE WHEN nxt - date = 1 THEN 1 ELSE 0 END AS is_day_before_holiday,
       CASE WHEN date - prev = 1 THEN 1 ELSE 0 END AS is_day_after_holiday
FROM (SELECT date,
             MAX(CASE WHEN h = 1 THEN date END)
               OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev,
             MIN(CASE WHEN h = 1 THEN date END)
               OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt
      FROM holiday_days)""",
    "feature_rows": _features_sql(),
    "daily": """
SELECT *, CAST(date - (SELECT MIN(date) FROM panel) AS INTEGER) AS trend FROM panel""",
    "split": f"""
SELECT *, date >= MAX(date) OVER ({_PAIR}) - {VALID_DAYS - 1} AS is_valid,
       LAG(sales, 7) OVER ({_PAIR} ORDER BY date) AS naive_lag7,
       AVG(sales) OVER ({_PAIR} ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
         AS naive_ma7
FROM daily""",
    "fit": """
SELECT store_nbr, family,
       REGR_SLOPE(CASE WHEN NOT is_valid THEN sales END, CASE WHEN NOT is_valid THEN trend END)
         AS slope,
       REGR_INTERCEPT(CASE WHEN NOT is_valid THEN sales END,
                      CASE WHEN NOT is_valid THEN trend END) AS intercept
FROM split GROUP BY 1, 2""",
    "gate": """
SELECT store_nbr, family FROM split GROUP BY 1, 2
HAVING COUNT(CASE WHEN is_valid THEN 1 END) >= 7""",
    "held": """
SELECT s.*, f.intercept + f.slope * s.trend AS y_pred
FROM split s JOIN gate USING (store_nbr, family) JOIN fit f USING (store_nbr, family)
WHERE s.is_valid""",
    "fold_windows": f"""
SELECT store_nbr, family, n_rows, fold,
       last - ({FOLDS - 1} - fold) * {VALID_DAYS} - {VALID_DAYS - 1} AS fold_start,
       last - ({FOLDS - 1} - fold) * {VALID_DAYS} AS fold_end
FROM (SELECT store_nbr, family, MAX(date) AS last, COUNT(*) AS n_rows FROM daily GROUP BY 1, 2),
     (SELECT CAST(UNNEST(RANGE({FOLDS})) AS INTEGER) AS fold)""",
    "fold_rows": """
SELECT d.*, w.fold, w.n_rows, d.date BETWEEN w.fold_start AND w.fold_end AS in_fold,
       d.date < w.fold_start AS in_past
FROM daily d JOIN fold_windows w USING (store_nbr, family)""",
    "fold_fit": """
SELECT store_nbr, family, fold,
       REGR_SLOPE(CASE WHEN NOT in_fold THEN sales END, CASE WHEN NOT in_fold THEN trend END)
         AS slope,
       REGR_INTERCEPT(CASE WHEN NOT in_fold THEN sales END,
                      CASE WHEN NOT in_fold THEN trend END) AS intercept
FROM fold_rows GROUP BY 1, 2, 3""",
    "fold_metrics": f"""
SELECT store_nbr, family, fold, {mae_mape("sales", "p")}, COUNT(*) AS n_fold
FROM (SELECT r.*, f.intercept + f.slope * r.trend AS p
      FROM fold_rows r JOIN fold_fit f USING (store_nbr, family, fold) WHERE r.in_fold)
GROUP BY 1, 2, 3
HAVING COUNT(*) >= GREATEST(7, CAST(FLOOR(0.05 * MAX(n_rows)) AS BIGINT))""",
    "metrics": f"""
SELECT m.*, c."CV_MAE", c."CV_MAPE_%",
       "NAIVE_LAG7_MAE" - "MAE" AS "MAE_GAIN_vs_LAG7", "NAIVE_MA7_MAE" - "MAE" AS "MAE_GAIN_vs_MA7"
FROM (SELECT store_nbr, family, {mae_mape("sales", "y_pred")},
             {mae_mape("sales", "naive_lag7", "NAIVE_LAG7_")},
             {mae_mape("sales", "naive_ma7", "NAIVE_MA7_")}
      FROM held GROUP BY 1, 2) m
LEFT JOIN (SELECT store_nbr, family, AVG("MAE") AS "CV_MAE", AVG("MAPE_%") AS "CV_MAPE_%"
           FROM fold_metrics GROUP BY 1, 2) c USING (store_nbr, family)""",
    "residual_shift": """
SELECT store_nbr, family, quantile,
       CASE WHEN quantile = 0.5 THEN q50 ELSE q90 END AS shift
FROM (SELECT s.store_nbr, s.family,
             QUANTILE_CONT(s.sales - (f.intercept + f.slope * s.trend), 0.5) AS q50,
             QUANTILE_CONT(s.sales - (f.intercept + f.slope * s.trend), 0.9) AS q90
      FROM split s JOIN fit f USING (store_nbr, family) WHERE NOT s.is_valid GROUP BY 1, 2),
     (SELECT CAST(UNNEST([0.5, 0.9]) AS DOUBLE) AS quantile)""",
    "point_registry": """
SELECT store_nbr, family, slope, intercept FROM fit JOIN gate USING (store_nbr, family)
WHERE slope IS NOT NULL""",
    "quantile_registry": """
SELECT r.store_nbr, r.family, q.quantile, r.slope, r.intercept + q.shift AS intercept
FROM point_registry r JOIN residual_shift q USING (store_nbr, family)""",
    "requests": "SELECT store_nbr, family, date, trend, sales FROM daily",
    "tail_rows": f"""
SELECT store_nbr, family, date, trend, sales FROM (
  SELECT *, ROW_NUMBER() OVER ({_PAIR} ORDER BY date DESC) AS rn FROM daily) WHERE rn <= 30""",
    "scored": """
SELECT q.*, r.intercept + r.slope * q.trend AS pred_qty,
       CASE WHEN r.slope IS NULL THEN 'Model not found' END AS error
FROM requests q LEFT JOIN point_registry r USING (store_nbr, family)""",
    "tail30": """
SELECT store_nbr, family, AVG(sales) AS daily_mean, STDDEV_SAMP(sales) AS sd, COUNT(*) AS n
FROM tail_rows GROUP BY 1, 2""",
    "strict_ma7": f"""
SELECT store_nbr, family,
       CASE WHEN MAX(n) >= {VALID_DAYS + 8}
            THEN AVG(CASE WHEN back <= {VALID_DAYS} THEN {ape("sales", "p")} END) * 100 END
         AS "naive_MAPE_%"
FROM (SELECT *, ROW_NUMBER() OVER ({_PAIR} ORDER BY date DESC) AS back,
             COUNT(*) OVER ({_PAIR}) AS n,
             AVG(sales) OVER ({_PAIR} ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS p
      FROM panel) GROUP BY 1, 2""",
    "impact": """
SELECT *, under_cost_naive - under_cost_model AS savings_under,
       over_cost_naive - over_cost_model AS savings_over_per_day
FROM (SELECT *, CASE WHEN "SS_naive" IS NOT NULL
                     THEN (CAST(1 AS DOUBLE) - CAST(0.95 AS DOUBLE)) * daily_mean * 2 * (margin_rate * price) END AS under_cost_naive,
             CASE WHEN "SS_model" IS NOT NULL
                  THEN (CAST(1 AS DOUBLE) - CAST(0.95 AS DOUBLE)) * daily_mean * 2 * (margin_rate * price) END AS under_cost_model,
             holding_cost * "SS_naive" AS over_cost_naive,
             holding_cost * "SS_model" AS over_cost_model
      FROM (SELECT *, 1.6449 * sigma_naive * SQRT(2) AS "SS_naive",
                   1.6449 * sigma_model * SQRT(2) AS "SS_model",
                   daily_mean * 2 + 1.6449 * sigma_naive * SQRT(2) AS "ROP_naive",
                   daily_mean * 2 + 1.6449 * sigma_model * SQRT(2) AS "ROP_model"
            FROM (SELECT t.store_nbr, t.family, t.daily_mean, n."naive_MAPE_%",
                         m."MAPE_%" AS "model_MAPE_%",
                         n."naive_MAPE_%" / 100 * t.daily_mean AS sigma_naive,
                         m."MAPE_%" / 100 * t.daily_mean AS sigma_model,
                         COALESCE(pr.price, 3.5) AS price,
                         COALESCE(pr.margin_rate, 0.25) AS margin_rate,
                         COALESCE(pr.holding_cost, 0.05) AS holding_cost
                  FROM tail30 t JOIN strict_ma7 n USING (store_nbr, family)
                  LEFT JOIN metrics m USING (store_nbr, family)
                  LEFT JOIN prices pr USING (family))))""",
    "promo_rows": f"""
SELECT *, CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END AS promo,
       date >= (SELECT MAX(date) FROM daily) - {VALID_DAYS - 1} AS is_valid FROM daily""",
    "promo_held": """
SELECT h.*, m.p FROM promo_rows h
JOIN (SELECT promo, AVG(sales) AS p FROM promo_rows WHERE NOT is_valid GROUP BY 1) m USING (promo)
WHERE h.is_valid""",
    "ridge_split": ridge_two("split", "NOT is_valid", "store_nbr, family"),
    "ridge_whole": ridge_two("daily", "TRUE", "store_nbr, family"),
    "ridge_folds": ridge_two("fold_rows", "NOT in_fold", "store_nbr, family, fold"),
    "ridge_held": """
SELECT s.store_nbr, s.family, r.setting, s.sales, r.w1 * s.onpromotion + r.w2 * s.trend + r.b AS p
FROM split s JOIN gate USING (store_nbr, family) JOIN ridge_split r USING (store_nbr, family)
WHERE s.is_valid""",
    "recent_rows": f"""
SELECT * FROM panel WHERE date >= (SELECT MAX(date) FROM panel) - {RECENT_DAYS - 1}""",
    "recent_valid": f"""
SELECT * FROM panel WHERE date >= (SELECT MAX(date) FROM panel) - {VALID_DAYS - 1}""",
    "top20": """
SELECT store_nbr, family, SUM(sales) AS sales FROM recent_rows GROUP BY 1, 2
ORDER BY sales DESC, store_nbr, family LIMIT 20""",
    "board": """
SELECT m.store_nbr, m.family, m."MAE", m."MAPE_%", m."NAIVE_LAG7_MAE", m."NAIVE_MA7_MAE",
       t.n AS "N", t.s AS "SUM_Y", m."MAE" * t.n / NULLIF(t.s, 0) * 100 AS "wMAPE_%_est"
FROM metrics m
LEFT JOIN (SELECT store_nbr, family, COUNT(sales) AS n, SUM(sales) AS s FROM recent_valid
           GROUP BY 1, 2) t USING (store_nbr, family)""",
}
