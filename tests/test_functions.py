import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import metrics as M
from shelfcast.functions import text, vectors
from shelfcast.functions.service import z_from_service_level


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "level,z",
    [(0.95, 1.6449), (0.925, 1.6449), (None, 1.6449), (0.0, 1.6449), (0.5, 0.8416), (1.0, 2.3263)],
)
def test_nearest_service_level(spark, level, z):
    assert one(spark, z_from_service_level(F.lit(level).cast("double"))) == z


@pytest.mark.parametrize(
    "name,key",
    [
        ("BREAD/BAKERY", "BREAD_BAKERY"),
        ("LIQUOR,WINE,BEER", "LIQUOR_WINE_BEER"),
        ("///", "family"),
        ("_.a-b.", "a-b"),
    ],
)
def test_safe_key(spark, name, key):
    assert one(spark, text.safe_key(F.lit(name))) == key


def test_model_key_round_trip(spark):
    key = text.model_key(F.lit(7), F.lit("GROCERY I"), F.lit(0.9))
    parts = text.parse_model_key(key)
    row = spark.range(1).select(key.alias("k"), *[c.alias(n) for n, c in parts.items()]).first()
    assert tuple(row) == ("7__GROCERY_I__q90", 7, "GROCERY I", 0.9)
    plain = text.parse_model_key(F.lit("nonsense"))
    assert one(spark, plain["key_store"]) is None and one(spark, plain["key_quantile"]) is None


def test_lists(spark):
    assert one(spark, text.parse_numbers(F.lit("0.5, x,0.9,"))) == [0.5, 0.9]
    assert one(spark, text.parse_names(F.lit("a, b,,a"))) == ["a", "b"]


def test_metrics_guard_zero_and_null(spark):
    rows = [(0.0, 2.0), (4.0, 2.0), (None, 1.0), (3.0, None)]
    df = spark.createDataFrame(rows, "y double, p double")
    out = df.agg(M.mae(F.col("y"), F.col("p")).alias("a"), M.mape(F.col("y"), F.col("p")).alias("m"))
    assert tuple(out.first()) == (2.0, 125.0)
    assert df.filter("y > 9").agg(M.mape(F.col("y"), F.col("p"))).first()[0] is None
    assert one(spark, M.weighted_mape(F.lit(1.0), F.lit(3), F.lit(0.0))) is None


def test_coverage_accepts_swapped_bounds(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (5.0, 0.0, 2.0)], "y double, a double, b double")
    got = df.agg(M.coverage(F.col("y"), F.col("a"), F.col("b")), M.band_width(F.col("a"), F.col("b")))
    assert tuple(got.first()) == (0.5, 2.0)


def test_coercion(spark):
    texts = [("1.5", 1.5), ("abc", 0.0), (None, 0.0), ("NaN", 0.0), (" 2 ", 2.0)]
    for value, want in texts:
        assert one(spark, vectors.coerce_feature(F.lit(value).cast("string"))) == want
    assert one(spark, vectors.coerce_feature(F.lit(True), T.BooleanType())) == 1.0


def test_linear_score_of_a_feature_map(spark):
    # least squares on (0,0)->0, (1,2)->2, (2,1)->2, (3,3)->4.5
    x = np.array([[0, 0, 1], [1, 2, 1], [2, 1, 1], [3, 3, 1]], float)
    w = np.linalg.lstsq(x, np.array([0, 2, 2, 4.5]), rcond=None)[0]
    request = vectors.json_features(F.lit('{"b": 2, "a": 1}'))
    vector = vectors.features_to_vector(request, F.array(F.lit("a"), F.lit("b"), F.lit("absent")))
    weights = F.array(F.lit(float(w[0])), F.lit(float(w[1])), F.lit(9.0))
    got = one(spark, vectors.linear_score(vector, weights, F.lit(float(w[2]))))
    assert got == pytest.approx(w[0] + 2 * w[1] + w[2])
