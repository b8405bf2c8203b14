"""Projections, filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.catalog.base import query
from shelfcast.catalog.settings import RECENT_DAYS, VALID_DAYS
from shelfcast.functions import text
from shelfcast.functions.vectors import coerce_feature
from shelfcast.operators import panel as P
from shelfcast.operators import select as S
from shelfcast.operators import split as X
from shelfcast.plans import features as FT
from shelfcast.plans import models
from shelfcast.plans.features import make_features
from shelfcast.session import fresh_path
from shelfcast.sources import warehouse
from shelfcast.sources.raw import order_exogenous

KEY = "date:d store_nbr:i family:s"


@query(
    "b1_calendar_parts",
    f"{KEY} year:i month:i week:i day:i dayofweek:i quarter:i is_weekend:i is_month_start:i"
    " is_month_end:i",
    """
SELECT date, store_nbr, family, year(date) AS year, month(date) AS month,
       weekofyear(date) AS week, day(date) AS day, isodow(date) - 1 AS dayofweek,
       quarter(date) AS quarter, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end
FROM panel""",
)
def _(s):
    return P.add_calendar(s.panel)


@query(
    "b2_cyclic",
    f"{KEY} dow_sin:f dow_cos:f month_sin:f month_cos:f",
    """
SELECT date, store_nbr, family,
       SIN(2 * PI() * (isodow(date) - 1) / 7) AS dow_sin,
       COS(2 * PI() * (isodow(date) - 1) / 7) AS dow_cos,
       SIN(2 * PI() * (month(date) - 1) / 12) AS month_sin,
       COS(2 * PI() * (month(date) - 1) / 12) AS month_cos
FROM panel""",
)
def _(s):
    return P.add_calendar(s.panel)


@query("b3_trend", f"{KEY} trend:i", "SELECT date, store_nbr, family, trend FROM daily")
def _(s):
    return P.add_trend(s.panel)


@query(
    "b4_special_days",
    f"{KEY} is_christmas:i is_newyear:i is_black_friday:i",
    """
SELECT date, store_nbr, family,
       CASE WHEN month(date) = 12 AND day(date) = 25 THEN 1 ELSE 0 END AS is_christmas,
       CASE WHEN month(date) = 1 AND day(date) = 1 THEN 1 ELSE 0 END AS is_newyear,
       CASE WHEN month(date) = 11 AND isodow(date) = 5 AND day(date) BETWEEN 23 AND 29
            THEN 1 ELSE 0 END AS is_black_friday
FROM panel""",
)
def _(s):
    return P.add_special_days(s.panel)


@query(
    "b5_drop_null_target",
    f"{KEY} sales:f sales_lag_1:f",
    """
SELECT * FROM (
  SELECT date, store_nbr, family, sales,
         LAG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date) AS sales_lag_1
  FROM (SELECT date, store_nbr, family, CASE WHEN onpromotion = 0 THEN NULL ELSE sales END AS sales
        FROM panel))
WHERE sales IS NOT NULL""",
)
def _(s):
    from shelfcast.operators.windows import Rolling, add_rolling

    # the panel has no missing target: unpromoted days play that part here
    masked = s.panel.withColumn("sales", F.when(F.col("onpromotion") != 0, F.col("sales")))
    return S.drop_null_target(add_rolling(masked, [Rolling("sales", (1,))]))


@query(
    "b6_pair_filter",
    f"{KEY} sales:f",
    "SELECT date, store_nbr, family, sales FROM panel WHERE store_nbr = 7 AND family = 'ECONOMY'",
)
def _(s):
    return S.only_pair(s.panel, 7, "ECONOMY")


@query(
    "b6_pruned_pair",
    f"{KEY} sales:f",
    "SELECT date, store_nbr, family, sales FROM panel WHERE store_nbr = 7 AND family = 'ECONOMY'",
)
def _(s):
    root = fresh_path(s.spark, "wh")
    path = warehouse.write_parquet(s.panel, root, "train", warehouse.PARTITIONING["train"])
    return S.only_pair(warehouse.read_parquet(s.spark, path, schemas.TRAIN), 7, "ECONOMY")


@query("b7_recent", f"{KEY} sales:f", "SELECT date, store_nbr, family, sales FROM recent_rows")
def _(s):
    return S.recent(s.panel, RECENT_DAYS)


@query(
    "b8_holdout",
    f"{KEY} is_valid:b is_valid_global:b",
    f"""
SELECT date, store_nbr, family, is_valid,
       date >= (SELECT MAX(date) FROM panel) - {VALID_DAYS - 1} AS is_valid_global
FROM split""",
)
def _(s):
    by_pair = X.add_holdout(s.stored_panel, VALID_DAYS).withColumnRenamed("is_valid", "by_pair")
    both = X.add_holdout(by_pair, VALID_DAYS, "global")
    return both.withColumnRenamed("is_valid", "is_valid_global").withColumnRenamed(
        "by_pair", "is_valid"
    )


@query(
    "b8_gates",
    "store_nbr:i family:s n_rows:l n_valid:l n_train:l basic:b forest:b",
    f"""
SELECT *, n_valid >= 7 AS basic,
       n_valid >= GREATEST(7, GREATEST(1, CAST(FLOOR(LEAST({VALID_DAYS}, n_rows) / 2) AS BIGINT)))
         AND n_train >= 20 AND n_valid >= 7 AS forest
FROM (SELECT store_nbr, family, COUNT(*) AS n_rows,
             COUNT(CASE WHEN is_valid THEN 1 END) AS n_valid,
             COUNT(CASE WHEN NOT is_valid THEN 1 END) AS n_train
      FROM split GROUP BY 1, 2)""",
)
def _(s):
    counts = X.split_counts(X.add_holdout(s.stored_panel, VALID_DAYS))
    return counts.withColumns({"basic": X.basic_gate(), "forest": X.forest_gate(VALID_DAYS)})


@query(
    "b9_members",
    f"{KEY} sales:f",
    """
SELECT date, store_nbr, family, sales FROM panel
WHERE store_nbr IN (1, 2, 3, 5, 8, 13, 21) AND family IN ('ECONOMY', 'SMALL')""",
)
def _(s):
    return S.members(s.panel, [1, 2, 3, 5, 8, 13, 21], ["ECONOMY", "SMALL"])


NUMERIC_FEATURES = [
    c for c in FT.FEATURE_COLUMNS if c not in ("id", "date", "sales", "family", "city", "state", "type")
]


@query(
    "b10_feature_columns",
    "feature:s n:l lowest:f highest:f",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT({c}) AS n, CAST(MIN({c}) AS DOUBLE) AS lowest,"
        f" CAST(MAX({c}) AS DOUBLE) AS highest FROM feature_rows"
        for c in NUMERIC_FEATURES
    ),
)
def _(s):
    df = s.features
    # one wide partial aggregate; the long form is built from its single row
    stats = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(c).alias("n"),
            F.min(c).cast("double").alias("lowest"),
            F.max(c).cast("double").alias("highest"),
        )
        for c in FT.numeric_features(df)
    ]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


@query(
    "b11_align_features",
    "trend:f not_there:f sales:f family:f",
    "SELECT trend, 0.0 AS not_there, sales, 0.0 AS family FROM daily",
)
def _(s):
    return S.align_features(s.daily, ["trend", "not_there", "sales", "family"], numeric=True)


@query(
    "b12_coerce_feature",
    "event_id:l from_text:f from_number:f from_bool:f from_json:f",
    """
SELECT event_id, COALESCE(TRY_CAST(event_type AS DOUBLE), 0) AS from_text,
       COALESCE(value, 0) AS from_number,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS from_bool,
       COALESCE(TRY_CAST(REPLACE(REPLACE(props, '{"k": ', ''), '}', '') AS DOUBLE), 0) AS from_json
FROM events""",
)
def _(s):
    raw_number = F.replace(F.replace("props", F.lit('{"k": ')), F.lit("}"))
    flag = F.col("event_type") == "error"
    from pyspark.sql.types import BooleanType

    return s.table("events").select(
        "event_id",
        coerce_feature(F.col("event_type")).alias("from_text"),
        coerce_feature(F.col("value")).alias("from_number"),
        coerce_feature(flag, BooleanType()).alias("from_bool"),
        coerce_feature(raw_number).alias("from_json"),
    )


@query(
    "b13_encode_categories",
    f"{KEY} store_nbr_code:i family_code:i city_code:i is_promo_code:i",
    """
SELECT date, store_nbr, family,
       DENSE_RANK() OVER (ORDER BY store_nbr) - 1 AS store_nbr_code,
       DENSE_RANK() OVER (ORDER BY family) - 1 AS family_code,
       CASE WHEN city IS NULL THEN -1 ELSE DENSE_RANK() OVER (ORDER BY city NULLS LAST) - 1 END
         AS city_code,
       CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END AS is_promo_code
FROM panel LEFT JOIN (SELECT store_nbr, city FROM stores WHERE type <> 'A') USING (store_nbr)""",
)
def _(s):
    # stores of type A are left out, so their rows have no city to encode
    some = s.stores.filter(F.col("type") != "A").select("store_nbr", "city")
    df = s.stored_panel.join(some, "store_nbr", "left")
    df = df.withColumn("is_promo", F.col("onpromotion") > 0)
    return S.encode_categories(df, ["store_nbr", "family", "city", "is_promo"])


@query(
    "b13_encode_all",
    f"{KEY} city_code:i type_code:i",
    """
SELECT date, store_nbr, family, DENSE_RANK() OVER (ORDER BY city) - 1 AS city_code,
       DENSE_RANK() OVER (ORDER BY type) - 1 AS type_code
FROM panel JOIN stores USING (store_nbr)""",
)
def _(s):
    df = s.stored_panel.join(s.stores.select("store_nbr", "city", "type"), "store_nbr")
    return S.encode_categories(df, ["city", "type"])


@query(
    "b14_null_handling",
    f"{KEY} oil_clean:f oil_filled:f sales_per_promo:f",
    """
SELECT date, store_nbr, family, oil_price AS oil_clean, COALESCE(oil_price, 0) AS oil_filled,
       sales / NULLIF(onpromotion, 0) AS sales_per_promo
FROM dims""",
)
def _(s):
    nan = F.when(F.col("oil_price").isNull(), F.lit(float("nan"))).otherwise(F.col("oil_price"))
    df = s.dims.withColumns({"oil_clean": nan, "oil_filled": nan})
    df = S.clean_nulls(df, ["oil_clean"])
    df = S.clean_nulls(df, ["oil_filled"], fill=0.0)
    return df.withColumn("sales_per_promo", F.col("sales") / F.nullif("onpromotion", F.lit(0.0)))


@query(
    "b15_display_round",
    "store_nbr:i family:s price:f mean_sales:f",
    """
SELECT store_nbr, family, ROUND_EVEN(MAX(price) * 100, 0) / 100 AS price,
       ROUND_EVEN(CAST(SUM(sales) AS DOUBLE) / COUNT(*) * 100, 0) / 100 AS mean_sales
FROM panel JOIN prices USING (family) GROUP BY 1, 2""",
)
def _(s):
    priced = s.panel.join(s.prices, "family")
    means = priced.groupBy("store_nbr", "family").agg(
        F.max("price").alias("price"), F.avg("sales").alias("mean_sales")
    )
    return S.round_display(means, ["price", "mean_sales"])


_KEY_TEXT = "p_type || '/' || p_brand || ',, ' || p_name || '.'"


@query(
    "b16_safe_key",
    "p_partkey:l key:s edge:s",
    f"""
SELECT p_partkey,
       REGEXP_REPLACE(REGEXP_REPLACE({_KEY_TEXT}, '[^0-9A-Za-z\\-_.]+', '_', 'g'),
                      '^[._-]+|[._-]+$', '', 'g') AS key,
       COALESCE(NULLIF(REGEXP_REPLACE(REGEXP_REPLACE(
         CASE WHEN p_size > 25 THEN '///' ELSE '-' || p_name END, '[^0-9A-Za-z\\-_.]+', '_', 'g'),
         '^[._-]+|[._-]+$', '', 'g'), ''), 'family') AS edge
FROM part""",
)
def _(s):
    name = F.expr(_KEY_TEXT)
    edge = F.when(F.col("p_size") > 25, F.lit("///")).otherwise(
        F.concat(F.lit("-"), F.col("p_name"))
    )
    return s.table("part").select(
        "p_partkey", text.safe_key(name).alias("key"), text.safe_key(edge).alias("edge")
    )


@query(
    "b17_registry_keys",
    "key:s key_store:i key_family:s key_quantile:f",
    """
SELECT key, TRY_CAST(SPLIT_PART(key, '__', 1) AS INTEGER) AS key_store,
       REPLACE(REGEXP_REPLACE(REGEXP_REPLACE(key, '^.*?__', ''), '__q[0-9]+$', ''), '_', ' ')
         AS key_family,
       TRY_CAST(NULLIF(REGEXP_EXTRACT(key, '__q([0-9]+)$', 1), '') AS INTEGER) / 100.0
         AS key_quantile
FROM (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) || '__' || REPLACE(p_type || ' ' || p_name, ' ', '_')
             || CASE WHEN p_size > 40 THEN '' ELSE '__q' || CAST(p_size AS VARCHAR) END AS key
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)""",
)
def _(s):
    parts = s.table("part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_name", "p_size"
    )
    family = F.concat_ws(" ", "p_type", "p_name")
    plain = text.model_key(F.col("store_nbr"), family)
    quantile = text.model_key(F.col("store_nbr"), family, F.col("p_size") / 100.0)
    keys = (
        s.shipments.join(parts, "l_partkey")
        .select(F.when(F.col("p_size") > 40, plain).otherwise(quantile).alias("key"))
        .distinct()
    )
    return keys.select("key", *[c.alias(n) for n, c in text.parse_model_key(F.col("key")).items()])


@query(
    "b18_optional_inputs",
    f"{KEY} onpromotion:f is_holiday:i transactions:f oil_price:f",
    """
SELECT date, store_nbr, family, 0.0 AS onpromotion, 0 AS is_holiday, CAST(NULL AS DOUBLE)
       AS transactions, CAST(NULL AS DOUBLE) AS oil_price FROM panel""",
)
def _(s):
    return FT.add_dimensions(s.panel.drop("onpromotion"))


@query(
    "b19_table_roles",
    f"{KEY} is_holiday:i transactions:f oil_price:f",
    """
SELECT date, store_nbr, family, is_holiday, transactions, oil_price FROM dims""",
)
def _(s):
    # tables handed over in the other accepted order
    holidays, transactions, oil = order_exogenous(s.transactions, s.oil, s.holidays)
    return FT.add_dimensions(s.panel, holidays, transactions, oil, s.stores)


@query(
    "b20_parse_lists",
    "n:i quantile:f users:l",
    """
SELECT len(qs) AS n, UNNEST(qs) AS quantile, users
FROM (SELECT [TRY_CAST(TRIM(x) AS DOUBLE) FOR x IN STRING_SPLIT(spec, ',')
              IF TRY_CAST(TRIM(x) AS DOUBLE) IS NOT NULL] AS qs, COUNT(*) AS users
      FROM (SELECT '0.5, ' || CAST(user_id / 100 AS VARCHAR) || ',' || event_type AS spec
            FROM (SELECT CAST(user_id AS DOUBLE) AS user_id, event_type FROM events))
      GROUP BY spec)""",
)
def _(s):
    # a quantile list per user and event type, with an entry that is no number
    spec = F.concat(
        F.lit("0.5, "), (F.col("user_id").cast("double") / 100).cast("string"), F.lit(","), "event_type"
    )
    lists = s.table("events").groupBy(spec.alias("spec")).agg(F.count(F.lit(1)).alias("users"))
    return lists.withColumn("qs", text.parse_numbers(F.col("spec"))).select(
        F.size("qs").alias("n"), F.explode("qs").alias("quantile"), "users"
    )


@query(
    "b20_parse_names",
    "name:s users:l",
    """
SELECT name, COUNT(*) AS users
FROM (SELECT user_id, UNNEST(LIST_DISTINCT([TRIM(x) FOR x IN STRING_SPLIT(names, ',')
             IF TRIM(x) <> ''])) AS name
      FROM (SELECT user_id, event_type || ' , ,' || event_type || ', u' || CAST(user_id % 7 AS VARCHAR)
                   AS names FROM events))
GROUP BY 1""",
)
def _(s):
    # a list with an empty entry and a repeated one
    names = F.concat(
        "event_type", F.lit(" , ,"), "event_type", F.lit(", u"), (F.col("user_id") % 7).cast("string")
    )
    parsed = s.table("events").select(F.explode(text.parse_names(names)).alias("name"))
    return parsed.groupBy("name").agg(F.count(F.lit(1)).alias("users"))


@query(
    "b21_target_transforms",
    f"{KEY} log_sales:f back:f weight:f",
    """
SELECT date, store_nbr, family, LN(1 + sales) AS log_sales, sales AS back,
       1 / GREATEST(sales, 1) AS weight
FROM panel""",
)
def _(s):
    logged = s.panel.withColumn("log_sales", models.target_column(True))
    return logged.withColumns(
        {
            "back": models.inverse_target(F.col("log_sales"), True),
            "weight": models.sample_weight(True),
        }
    )


def _remaining(group: str) -> list[str]:
    gone = {*FT.NOT_FEATURES, *FT.FEATURE_GROUPS[group]}
    return [c for c in FT.FEATURE_COLUMNS if c not in gone]


@query(
    "b22_feature_groups",
    "feature_group:s n_features:i n_rows:l n_values:l",
    " UNION ALL ".join(
        f"SELECT '{g}' AS feature_group, {len(_remaining(g))} AS n_features, COUNT(*) AS n_rows,"
        f" {' + '.join(f'COUNT({c})' for c in _remaining(g))} AS n_values FROM feature_rows"
        for g in FT.FEATURE_GROUPS
    ),
)
def _(s):
    df = make_features(s.panel, s.holidays, s.transactions, s.oil, s.stores)
    # counts of all columns in one pass; a group's row sums those of what it leaves
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in FT.feature_columns(df)]
    )
    entries = []
    for group in FT.FEATURE_GROUPS:
        left = FT.feature_columns(FT.drop_feature_group(df, group))
        values = reduce(lambda a, b: a + b, [F.col(f"n_{c}") for c in left])
        entries.append(
            F.struct(
                F.lit(group).alias("feature_group"),
                F.lit(len(left)).alias("n_features"),
                values.alias("n_values"),
            )
        )
    return counts.select(F.inline(F.array(*entries)), "n_rows")