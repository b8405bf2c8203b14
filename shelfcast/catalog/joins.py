"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.base import query
from shelfcast.catalog.settings import RECENT_DAYS, VALID_DAYS
from shelfcast.operators import panel as P
from shelfcast.operators import resample as R
from shelfcast.operators import select as S
from shelfcast.operators.evaluate import add_wmape, tail_totals
from shelfcast.plans import models, money, scoring
from shelfcast.schemas import PAIR

KEY = "date:d store_nbr:i family:s"


@query(
    "c1_stores",
    f"{KEY} city:s state:s type:s cluster:i",
    "SELECT date, store_nbr, family, city, state, type, cluster FROM panel JOIN stores USING (store_nbr)",
)
def _(s):
    return P.add_stores(s.panel, s.stores)


FLAGGED_SQL = "SELECT * FROM flagged"


@query("c2_national", f"{KEY} is_holiday_national:i", FLAGGED_SQL)
def _(s):
    return P.add_holidays(s.panel, s.holidays)


@query("c3_regional", f"{KEY} is_holiday_regional:i", FLAGGED_SQL)
def _(s):
    return P.add_holidays(P.add_stores(s.panel, s.stores.drop("city")), s.holidays)


@query("c4_local", f"{KEY} is_holiday_local:i", FLAGGED_SQL)
def _(s):
    return P.add_holidays(P.add_stores(s.panel, s.stores.drop("state")), s.holidays)


@query(
    "c5_is_holiday",
    f"{KEY} is_holiday_national:i is_holiday_regional:i is_holiday_local:i is_holiday:i",
    FLAGGED_SQL,
)
def _(s):
    return s.flagged


@query(
    "c6_transactions",
    f"{KEY} transactions:f",
    """
SELECT p.date, p.store_nbr, p.family, t.transactions FROM panel p
LEFT JOIN transactions t ON p.date = t.date AND p.store_nbr = t.store_nbr""",
)
def _(s):
    return P.add_transactions(s.panel, s.transactions)


@query(
    "c6_transactions_by_date",
    f"{KEY} transactions:f",
    """
SELECT p.date, p.store_nbr, p.family, t.transactions FROM panel p
LEFT JOIN (SELECT date, SUM(transactions) AS transactions FROM transactions GROUP BY 1) t
  ON p.date = t.date""",
)
def _(s):
    chain_wide = s.transactions.groupBy("date").agg(F.sum("transactions").alias("transactions"))
    return P.add_transactions(s.panel, chain_wide)


@query("c7_oil", f"{KEY} oil_price:f", "SELECT * FROM dims")
def _(s):
    return P.add_oil(s.panel, s.oil)


@query(
    "c8_holiday_distance",
    f"{KEY} days_from_prev_holiday:f days_to_next_holiday:f is_day_before_holiday:i"
    " is_day_after_holiday:i",
    "SELECT p.date, p.store_nbr, p.family, h.* EXCLUDE (date) FROM panel p JOIN holiday_distance h ON p.date = h.date",
)
def _(s):
    return P.add_holiday_distance(s.flagged)


@query(
    "c9_top_pair_rows",
    f"{KEY} sales:f",
    "SELECT p.* FROM panel p SEMI JOIN top20 USING (store_nbr, family)",
)
def _(s):
    return S.in_pairs(s.panel, S.top_pairs(s.panel, 20, RECENT_DAYS))


@query(
    "c10_untrained_pairs",
    "store_nbr:i family:s",
    """
SELECT DISTINCT store_nbr, family FROM panel
EXCEPT SELECT store_nbr, family FROM point_registry""",
)
def _(s):
    return S.not_in_pairs(s.stored_panel.select(*PAIR).distinct(), s.point_registry)


@query(
    "c11_model_mape",
    'store_nbr:i family:s model_MAPE_%:f',
    """
SELECT p.store_nbr, p.family, m."MAPE_%" AS "model_MAPE_%"
FROM (SELECT DISTINCT store_nbr, family FROM panel) p
LEFT JOIN metrics m USING (store_nbr, family)""",
)
def _(s):
    # every metric row twice: the lookup must still give one row per pair
    twice = s.metrics.unionByName(s.metrics.withColumn("MAE", F.col("MAE") + 1))
    return money.add_model_mape(s.stored_panel.select(*PAIR).distinct(), twice)


_STORE_PRICES = """
SELECT s_nationkey AS store_nbr, p_type AS family, MAX(p_retailprice) / 100 AS price
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_discount = 0 GROUP BY 1, 2"""


@query(
    "c12_prices",
    "store_nbr:i family:s price:f price_family:f margin_rate:f holding_cost:f",
    f"""
SELECT p.store_nbr, p.family, COALESCE(o.price, f.price, 3.5) AS price,
       COALESCE(f.price, 3.5) AS price_family, COALESCE(f.margin_rate, 0.25) AS margin_rate,
       COALESCE(f.holding_cost, 0.05) AS holding_cost
FROM (SELECT DISTINCT store_nbr, family FROM panel) p
LEFT JOIN (SELECT * FROM prices WHERE family <> 'SMALL') f USING (family)
LEFT JOIN ({_STORE_PRICES}) o USING (store_nbr, family)""",
)
def _(s):
    # family rows for all but one family, and store rows wherever a full-price line exists
    parts = s.table("part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("family"), "p_retailprice"
    )
    own = (
        s.shipments.filter("l_discount = 0")
        .join(parts, "l_partkey")
        .groupBy(*PAIR)
        .agg((F.max("p_retailprice") / 100).alias("price"))
    )
    rows = s.prices.filter(F.col("family") != "SMALL").unionByName(own, allowMissingColumns=True)
    pairs = s.panel.select(*PAIR).distinct()
    fixed = money.add_prices(pairs, rows, store_override=False)
    plain = fixed.select(*PAIR, F.col("price").alias("price_family"))
    return money.add_prices(pairs, rows).join(plain, PAIR)


@query(
    "c12_prices_all",
    "store_nbr:i family:s price:f margin_rate:f holding_cost:f",
    """
SELECT p.store_nbr, p.family, f.price, f.margin_rate, f.holding_cost
FROM (SELECT DISTINCT store_nbr, family FROM panel) p JOIN prices f USING (family)""",
)
def _(s):
    return money.add_prices(s.panel.select(*PAIR).distinct(), s.prices)


BOARD = 'store_nbr:i family:s MAE:f N:l SUM_Y:f wMAPE_%_est:f'


@query("c13_board_totals", BOARD, "SELECT * FROM board")
def _(s):
    return add_wmape(s.metrics, tail_totals(S.recent(s.stored_panel, VALID_DAYS)))


@query(
    "c14_sales_transactions",
    f"{KEY} sales:f transactions:f",
    """
SELECT p.date, p.store_nbr, p.family, p.sales, t.transactions FROM panel p
LEFT JOIN transactions t ON p.date = t.date AND p.store_nbr = t.store_nbr""",
)
def _(s):
    return R.sales_with_transactions(s.panel, s.transactions)


@query(
    "c15_request_models",
    f"{KEY} pred_qty:f error:s",
    "SELECT * FROM scored",
)
def _(s):
    return scoring.score_requests(s.requests, s.point_registry)


_GLOBAL_FIT = """
SELECT REGR_SLOPE(CASE WHEN NOT is_valid THEN sales END, CASE WHEN NOT is_valid THEN trend END) AS gs,
       REGR_INTERCEPT(CASE WHEN NOT is_valid THEN sales END, CASE WHEN NOT is_valid THEN trend END) AS gi
FROM split"""


@query(
    "c16_model_fallback",
    f"{KEY} pred_qty:f source:s",
    f"""
SELECT date, store_nbr, family, COALESCE(pred_qty, gi + gs * trend) AS pred_qty,
       CASE WHEN error IS NULL THEN 'pair' ELSE 'global' END AS source
FROM scored CROSS JOIN ({_GLOBAL_FIT}) g""",
)
def _(s):
    whole = models.fit_trend(s.split, ~F.col("is_valid"), keys=[])
    packed = whole.select(
        F.array(F.lit("trend")).alias("features"),
        F.array("slope").alias("weights"),
        "intercept",
    )
    return scoring.score_with_fallback(s.requests, s.point_registry, packed)
