"""Error metrics as aggregate expressions. Rows with a NULL side are skipped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def abs_error(y: Column, p: Column) -> Column:
    return F.abs(y - p)


def pct_error(y: Column, p: Column) -> Column:
    """Absolute relative error; a zero actual is divided by 1."""
    return F.abs((y - p) / F.when(y == 0, F.lit(1.0)).otherwise(y))


def mae(y: Column, p: Column) -> Column:
    return F.avg(abs_error(y, p))


def mape(y: Column, p: Column) -> Column:
    return F.avg(pct_error(y, p)) * 100.0


def weighted_mape(mae_col: Column, n: Column, total: Column) -> Column:
    """MAE times row count over total demand, in percent; NULL when demand is 0."""
    return mae_col * n / F.nullif(total, F.lit(0.0)) * 100.0


def coverage(y: Column, low: Column, high: Column) -> Column:
    inside = (y >= F.least(low, high)) & (y <= F.greatest(low, high))
    return F.avg(inside.cast("double"))


def band_width(low: Column, high: Column) -> Column:
    return F.avg(F.abs(high - low))
