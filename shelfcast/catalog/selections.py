"""Sorts, limits, top-k, set operations, maps and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.base import query
from shelfcast.catalog.settings import FOREST as SIZE
from shelfcast.catalog.settings import RECENT_DAYS, VALID_DAYS
from shelfcast.functions.vectors import features_to_vector, json_features
from shelfcast.operators import select as S
from shelfcast.operators.evaluate import error_metrics
from shelfcast.plans import attribution, models, reports
from shelfcast.schemas import PAIR, REQUIRED_COLUMNS
from shelfcast.session import materialize

PAIR_COLS = "store_nbr:i family:s"


@query(
    "f1_worst_pairs",
    f"{PAIR_COLS} MAE:f MAPE_%:f",
    'SELECT * FROM metrics ORDER BY "MAE" DESC, store_nbr, family LIMIT 50',
)
def _(s):
    return reports.metrics_report(s.metrics)["worst"]


@query(
    "f2_baseline_comparison",
    f"{PAIR_COLS} MAE:f NAIVE_LAG7_MAE:f NAIVE_LAG7_MAPE_%:f NAIVE_MA7_MAE:f NAIVE_MA7_MAPE_%:f",
    'SELECT * FROM metrics ORDER BY "MAE", store_nbr, family LIMIT 50',
)
def _(s):
    return reports.baseline_comparison(s.metrics)


@query(
    "f3_edge_store_pairs",
    PAIR_COLS,
    """
SELECT DISTINCT store_nbr, family FROM panel
WHERE store_nbr IN (SELECT store_nbr FROM (SELECT DISTINCT store_nbr FROM panel) ORDER BY 1 LIMIT 5)
   OR store_nbr IN (SELECT store_nbr FROM (SELECT DISTINCT store_nbr FROM panel)
                    ORDER BY 1 DESC LIMIT 5)""",
)
def _(s):
    return S.edge_store_pairs(s.panel, 5)


@query(
    "f4_multi_key_sort",
    "date:d store_nbr:i family:s sales:f",
    "SELECT date, store_nbr, family, sales FROM panel ORDER BY store_nbr, family, date",
)
def _(s):
    return s.panel.orderBy("store_nbr", "family", "date")


FOREST = [
    "onpromotion",
    "dayofweek",
    "month",
    "trend",
    "is_holiday",
    "transactions",
    "sales_lag_1",
    "sales_lag_7",
    "sales_rollmean_7",
    "sales_rollmean_30",
]


@query("f5_top_features", "feature:s importance:f")
def _(s):
    frame, inputs = models.model_frame(s.features, FOREST, valid_days=VALID_DAYS)
    written = materialize(frame, "forest-frame")
    model = models.fit_global(written, models.random_forest(inputs, **SIZE))
    return models.top_features(models.importances(model, inputs, s.spark))


@query(
    "f5_gain_one_split",
    "feature:s gain:f",
    """
SELECT 'promo' AS feature, v.n * v.s - SUM(g.n * g.s) AS gain
FROM (SELECT COUNT(*) AS n, VAR_POP(sales) AS s FROM promo_rows WHERE NOT is_valid) v,
     (SELECT promo, COUNT(*) AS n, VAR_POP(sales) AS s FROM promo_rows WHERE NOT is_valid GROUP BY 1) g
GROUP BY v.n, v.s
UNION ALL SELECT 'flat', 0""",
)
def _(s):
    rows = s.daily.withColumns({"promo": (F.col("onpromotion") > 0).cast("double"), "flat": F.lit(1.0)})
    frame, inputs = models.model_frame(rows, ["promo", "flat"], (), VALID_DAYS)
    tree = models.random_forest(inputs, trees=1, depth=1, bootstrap=False)
    tree.getStages()[-1].setFeatureSubsetStrategy("all")
    model = models.fit_global(materialize(frame, "promo-frame"), tree)
    nodes = attribution.tree_nodes(s.spark, model.stages[-1])
    return models.top_features(attribution.gain_importance(nodes, inputs), 15, "gain")


@query(
    "g1_union_all",
    "model:s store_nbr:i family:s MAE:f",
    """
SELECT 'lag' AS model, store_nbr, family, AVG(ABS(sales - naive_lag7)) AS "MAE" FROM held
GROUP BY 2, 3
UNION ALL
SELECT 'trend', store_nbr, family, AVG(ABS(sales - y_pred)) FROM held GROUP BY 2, 3""",
)
def _(s):
    # one pass over the holdout; the results of both models become rows of their own
    both = error_metrics(s.held, {"lag_": "naive_lag7", "trend_": "y_pred"})
    rows = [F.struct(F.lit(n).alias("model"), F.col(f"{n}_MAE").alias("MAE")) for n in ("lag", "trend")]
    parts = [both.select(*PAIR, r.alias("r")).select(*PAIR, "r.*") for r in rows]
    return parts[0].unionByName(parts[1])


@query(
    "g2_intersection",
    PAIR_COLS,
    """
SELECT store_nbr, family FROM top20 INTERSECT SELECT store_nbr, family FROM point_registry""",
)
def _(s):
    top = S.top_pairs(s.stored_panel, 20, RECENT_DAYS).select(*PAIR)
    return top.intersect(s.point_registry.select(*PAIR))


@query(
    "g3_difference",
    "missing:s rows_checked:l",
    """
SELECT UNNEST(['store_nbr', 'type']) AS missing, (SELECT COUNT(*) FROM oil) AS rows_checked""",
)
def _(s):
    wanted = sorted({*REQUIRED_COLUMNS["oil"], "store_nbr", "type"})
    required = F.array(*[F.lit(c) for c in wanted])
    actual = F.array(*[F.lit(c) for c in s.oil.columns])
    return s.oil.agg(F.count(F.lit(1)).alias("rows_checked")).select(
        F.explode(F.array_except(required, actual)).alias("missing"), "rows_checked"
    )


@query(
    "g3_dates_without_oil",
    "date:d",
    "SELECT DISTINCT date FROM panel EXCEPT SELECT date FROM oil",
)
def _(s):
    return s.panel.select("date").distinct().exceptAll(s.oil.select("date").distinct())


@query(
    "g4_deduplicate",
    "date:d locale:s locale_name:s",
    "SELECT DISTINCT date, locale, locale_name FROM holidays_events",
)
def _(s):
    return s.holidays.dropDuplicates(["date", "locale", "locale_name"])


@query(
    "h1_feature_vector",
    "date:d store_nbr:i family:s x0:f x1:f x2:f",
    "SELECT date, store_nbr, family, trend AS x0, 0.0 AS x1, sales AS x2 FROM daily",
)
def _(s):
    request = F.create_map(F.lit("sales"), F.col("sales"), F.lit("trend"), F.col("trend").cast("double"))
    names = F.array(F.lit("trend"), F.lit("absent"), F.lit("sales"))
    vector = s.daily.withColumn("x", features_to_vector(request, names))
    return vector.select(
        "date",
        "store_nbr",
        "family",
        *[F.element_at("x", i + 1).alias(f"x{i}") for i in range(3)],
    )


@query(
    "h2_json_features",
    "event_id:l k:f back:s",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       '{"k":' || CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR) || '}' AS back
FROM events""",
)
def _(s):
    parsed = s.table("events").withColumn("features", json_features(F.col("props")))
    return parsed.select(
        "event_id", F.col("features")["k"].alias("k"), F.to_json("features").alias("back")
    )
