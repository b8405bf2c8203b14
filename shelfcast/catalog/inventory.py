"""Stock plan, reorder points, money impact, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.base import query
from shelfcast.catalog.settings import VALID_DAYS
from shelfcast.functions.service import z_from_service_level
from shelfcast.operators import select as S
from shelfcast.plans import money, reports, scoring

PAIR_COLS = "store_nbr:i family:s"
IMPACT = f"{PAIR_COLS} " + " ".join(f"{c}:f" for c in money.IMPACT_COLUMNS[2:])


@query(
    "l1_stock_plan",
    f"{PAIR_COLS} daily_mean:f daily_std:f lead_time_days:i service_z:f safety_stock:f"
    " reorder_point:f",
    """
SELECT store_nbr, family, daily_mean, sd AS daily_std, 2 AS lead_time_days, 1.65 AS service_z,
       1.65 * sd * SQRT(2) AS safety_stock, daily_mean * 2 + 1.65 * sd * SQRT(2) AS reorder_point
FROM (SELECT store_nbr, family, daily_mean, CASE WHEN n > 1 THEN sd ELSE 0 END AS sd FROM tail30)""",
)
def _(s):
    return money.stock_plan(s.panel)


@query(
    "l2_service_level_z",
    "o_orderkey:l z:f",
    """
SELECT o_orderkey, CASE LEAST(d1, d2, d3, d4, d5) WHEN d1 THEN 0.8416 WHEN d2 THEN 1.2816
                        WHEN d3 THEN 1.6449 WHEN d4 THEN 1.96 ELSE 2.3263 END AS z
FROM (SELECT o_orderkey, ABS(CAST(0.8 AS DOUBLE) - p) AS d1, ABS(CAST(0.9 AS DOUBLE) - p) AS d2,
             ABS(CAST(0.95 AS DOUBLE) - p) AS d3, ABS(CAST(0.975 AS DOUBLE) - p) AS d4,
             ABS(CAST(0.99 AS DOUBLE) - p) AS d5
      FROM (SELECT o_orderkey, COALESCE(NULLIF(CASE WHEN o_orderstatus = 'P' THEN NULL
                     ELSE CAST(day(o_orderdate) - 1 AS DOUBLE) / 30 END, 0), 0.95) AS p FROM orders))""",
)
def _(s):
    # the day of the order as a share of the month stands for a service level
    level = F.when(
        F.col("o_orderstatus") != "P", (F.dayofmonth("o_orderdate") - 1).cast("double") / 30
    )
    return s.table("orders").select("o_orderkey", z_from_service_level(level).alias("z"))


@query(
    "l3_reorder_points",
    f"{PAIR_COLS} daily_mean:f sigma_daily:f lead_time_days:i service_level_z:f safety_stock:f"
    " reorder_point:f quantiles_used:b",
    """
SELECT *, service_level_z * sigma_daily * SQRT(lead_time_days) AS safety_stock,
       daily_mean * lead_time_days + service_level_z * sigma_daily * SQRT(lead_time_days)
         AS reorder_point
FROM (SELECT q.store_nbr, q.family, CASE WHEN a.intercept IS NOT NULL THEN a.intercept + a.slope * q.trend
                    ELSE q.pred_qty END AS daily_mean,
             CASE WHEN a.intercept IS NOT NULL
                  THEN GREATEST((b.intercept + b.slope * q.trend - (a.intercept + a.slope * q.trend))
                                / 1.2816, 0)
                  ELSE GREATEST(0.25 * q.pred_qty, 0) END AS sigma_daily,
             GREATEST(day(q.date) - 25, 1) AS lead_time_days,
             CASE WHEN q.store_nbr < 5 THEN 2.0 WHEN q.store_nbr < 12 THEN 1.6449 ELSE 1.2816 END
               AS service_level_z,
             a.intercept IS NOT NULL AS quantiles_used
      FROM scored q
      LEFT JOIN (SELECT * FROM quantile_registry WHERE quantile = 0.5 AND family <> 'SMALL') a
        USING (store_nbr, family)
      LEFT JOIN (SELECT * FROM quantile_registry WHERE quantile = 0.9 AND family <> 'SMALL') b
        USING (store_nbr, family)
      WHERE q.error IS NULL)""",
)
def _(s):
    # one family has no quantile models, and requests differ in lead time and level
    registry = s.registry.filter(F.col("quantile").isNull() | (F.col("family") != "SMALL"))
    asked = s.requests.withColumns(
        {
            "lead_time_days": F.dayofmonth("date") - 25,
            "service_level": F.when(F.col("store_nbr") >= 12, F.lit(0.9)),
            "service_level_z": F.when(F.col("store_nbr") < 5, F.lit(2.0)),
        }
    )
    return scoring.reorder_points(asked, registry)


@query(
    "l3_reorder_points_all",
    f"{PAIR_COLS} daily_mean:f sigma_daily:f lead_time_days:i service_level_z:f safety_stock:f"
    " reorder_point:f quantiles_used:b",
    """
SELECT *, service_level_z * sigma_daily * SQRT(lead_time_days) AS safety_stock,
       daily_mean * lead_time_days + service_level_z * sigma_daily * SQRT(lead_time_days)
         AS reorder_point
FROM (SELECT q.store_nbr, q.family, COALESCE(a.intercept + a.slope * q.trend, q.pred_qty) AS daily_mean,
             CASE WHEN a.intercept IS NOT NULL
                  THEN GREATEST((b.intercept + b.slope * q.trend - (a.intercept + a.slope * q.trend))
                                / 1.2816, 0)
                  ELSE GREATEST(0.25 * q.pred_qty, 0) END AS sigma_daily,
             2 AS lead_time_days, 1.6449 AS service_level_z, a.intercept IS NOT NULL AS quantiles_used
      FROM scored q
      LEFT JOIN (SELECT * FROM quantile_registry WHERE quantile = 0.5) a USING (store_nbr, family)
      LEFT JOIN (SELECT * FROM quantile_registry WHERE quantile = 0.9) b USING (store_nbr, family)
      WHERE q.error IS NULL)""",
)
def _(s):
    return scoring.reorder_points(s.requests, s.registry)


_MONEY = """
SELECT store_nbr, family, daily_mean, mape_pct, sigma,
       1.6449 * sigma * SQRT(2) AS safety_stock,
       daily_mean * 2 + 1.6449 * sigma * SQRT(2) AS reorder_point,
       (CAST(1 AS DOUBLE) - CAST(0.95 AS DOUBLE)) * daily_mean * 2 * (0.25 * 3.5) AS under_cost,
       0.05 * (1.6449 * sigma * SQRT(2)) AS over_cost
FROM (SELECT *, GREATEST(mape_pct / 100 * daily_mean, 0) AS sigma
      FROM (SELECT t.*, COALESCE(m."MAPE_%", 20) AS mape_pct
            FROM tail30 t LEFT JOIN metrics m USING (store_nbr, family)))"""
MONEY = (
    f"{PAIR_COLS} daily_mean:f mape_pct:f sigma:f safety_stock:f reorder_point:f under_cost:f"
    " over_cost:f"
)


@query("l4_pair_money", MONEY, f"SELECT * FROM ({_MONEY}) WHERE store_nbr = 7 AND family = 'ECONOMY'")
def _(s):
    return money.pair_money(S.only_pair(s.stored_panel, 7, "ECONOMY"), s.metrics)


@query("l4_money_all_pairs", MONEY, _MONEY)
def _(s):
    return money.pair_money(s.stored_panel, s.metrics)


@query("l5_impact_report", IMPACT, "SELECT * FROM impact")
def _(s):
    return money.impact_report(s.stored_panel, s.metrics, s.prices, valid_days=VALID_DAYS)


@query(
    "l6_impact_summary",
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
    report = money.impact_report(s.stored_panel, s.metrics, s.prices, valid_days=VALID_DAYS)
    return money.impact_summary(report)


@query(
    "l7_leaderboard",
    f"{PAIR_COLS} MAE:f MAPE_%:f wMAPE_%_est:f NAIVE_LAG7_MAE:f NAIVE_MA7_MAE:f",
    """
SELECT * FROM board WHERE family IN ('ECONOMY', 'LARGE', 'PROMO')
ORDER BY "MAPE_%" DESC, store_nbr, family LIMIT 40""",
)
def _(s):
    return reports.leaderboard(
        s.metrics,
        s.stored_panel,
        metric="MAPE_%",
        n=40,
        families=["ECONOMY", "LARGE", "PROMO"],
        valid_days=VALID_DAYS,
    )


@query(
    "l8_metrics_report",
    "section:s key:s MAE:f MAPE_%:f",
    """
SELECT 'by_store' AS section, CAST(store_nbr AS VARCHAR) AS key, AVG("MAE") AS "MAE",
       AVG("MAPE_%") AS "MAPE_%" FROM metrics GROUP BY 2
UNION ALL SELECT 'by_family', family, AVG("MAE"), AVG("MAPE_%") FROM metrics GROUP BY 2
UNION ALL SELECT 'summary', '', AVG("MAE"), AVG("MAPE_%") FROM metrics
UNION ALL SELECT * FROM (SELECT 'worst', CAST(store_nbr AS VARCHAR) || '/' || family, "MAE", "MAPE_%"
                         FROM metrics ORDER BY "MAE" DESC, store_nbr, family LIMIT 50)
UNION ALL SELECT * FROM (SELECT 'baselines', CAST(store_nbr AS VARCHAR) || '/' || family, "MAE",
                                "NAIVE_LAG7_MAPE_%"
                         FROM metrics ORDER BY "MAE", store_nbr, family LIMIT 50)""",
)
def _(s):
    tables = reports.metrics_report(s.metrics)
    pair = F.concat_ws("/", F.col("store_nbr").cast("string"), "family")
    shape = {
        "by_store": (F.col("store_nbr").cast("string"), "MAE", "`MAPE_%`"),
        "by_family": (F.col("family"), "MAE", "`MAPE_%`"),
        "summary": (F.lit(""), "mean_MAE", "mean_MAPE"),
        "worst": (pair, "MAE", "`MAPE_%`"),
        "baselines": (pair, "MAE", "`NAIVE_LAG7_MAPE_%`"),
    }
    parts = [
        tables[n].select(
            F.lit(n).alias("section"), k.alias("key"), F.col(a).alias("MAE"), F.col(b).alias("MAPE_%")
        )
        for n, (k, a, b) in shape.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
