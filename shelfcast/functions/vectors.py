"""Feature maps, ordered vectors and linear scoring as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURE_MAP = T.MapType(T.StringType(), T.DoubleType())


def coerce_feature(value: Column, dtype: T.DataType | None = None) -> Column:
    """Any value to a finite-or-zero double: NULL, NaN and non-numeric text become 0."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(value.cast("double"), F.lit(0.0))
    number = value.try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))


def features_to_vector(features: Column, names: Column) -> Column:
    """Map to array in the order of `names`; an absent or NULL entry is 0.0."""
    return F.transform(
        names, lambda n: F.coalesce(F.try_element_at(features, n), F.lit(0.0))
    )


def json_features(text: Column) -> Column:
    return F.from_json(text, FEATURE_MAP)


def linear_score(vector: Column, weights: Column, intercept: Column) -> Column:
    """intercept + sum(weight * value), folded left to right."""
    return F.aggregate(
        F.zip_with(vector, weights, lambda x, w: x * w), intercept, lambda acc, x: acc + x
    )
