"""Exact quantiles per group without holding a group in one place.

Every wanted rank is narrowed to an interval of values: the interval is cut into bins, the
rows of each bin are counted with a map-side part, and the bin that holds the rank becomes
the next interval. Once an interval holds few rows, only those are sorted. A group of any
size therefore costs a few passes and never more than `limit` sorted rows per interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.schemas import PAIR
from shelfcast.session import materialize

LIMIT = 20_000
BINS = 1_024


def grouped_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Sequence[float],
    keys: Sequence[str] = PAIR,
    limit: int = LIMIT,
    bins: int = BINS,
) -> DataFrame:
    """(keys, quantile, value): quantiles of the non-NULL values, linear between ranks.

    Groups without a value get none. `df` is read once per pass: hand in a written table.
    Keys must not be NULL.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    counts = materialize(counts, "rank-counts")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    position = F.col("quantile") * (F.col("_n") - 1)
    asked = counts.withColumn("quantile", F.explode(wanted)).select(
        *keys,
        "quantile",
        position.alias("_pos"),
        F.floor(position).alias("_below"),
        F.ceil(position).alias("_above"),
    )
    ranks = asked.select(*keys, F.explode(F.array("_below", "_above")).alias("_rank")).distinct()
    state = counts.join(ranks, keys).groupBy(*keys, "_lo", "_hi", "_n").agg(
        F.collect_list("_rank").alias("_ranks")
    )
    # rows below the interval
    state = state.withColumn("_skip", F.lit(0).cast("long"))
    crowded = (F.col("_n") > limit) & (F.col("_lo") < F.col("_hi"))
    while True:
        state = materialize(state, "rank-intervals")
        if state.filter(crowded).isEmpty():
            break
        state = state.filter(~crowded).unionByName(_narrowed(rows, state.filter(crowded), keys, bins))
    found = _sorted(rows, state.filter("_lo < _hi"), keys)
    # an interval of one value needs no sorting
    same = state.filter("_lo = _hi").select(*keys, F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_v"))
    found = found.unionByName(same)
    low = found.select(*keys, F.col("_rank").alias("_below"), F.col("_v").alias("_a"))
    high = found.select(*keys, F.col("_rank").alias("_above"), F.col("_v").alias("_b"))
    share = F.col("_pos") - F.col("_below")
    between = F.when(share == 0, F.col("_a")).otherwise(F.col("_a") * (1 - share) + F.col("_b") * share)
    joined = asked.join(low, [*keys, "_below"]).join(high, [*keys, "_above"])
    return joined.select(*keys, "quantile", between.alias("value"))


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """The intervals cut down to the bins that hold their ranks."""
    interval = [*keys, "_lo", "_hi", "_skip"]
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    inside = rows.join(state.drop("_n", "_ranks"), keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    binned = inside.withColumn("_bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
    counts = binned.groupBy(*interval, "_bin").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    # at most `bins` rows per interval
    order = Window.partitionBy(*interval).orderBy("_bin")
    before = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_first", F.col("_skip") + F.coalesce(before, F.lit(0)))
    targets = state.select(*interval, F.explode("_ranks").alias("_rank"))
    held = counts.join(targets, interval).filter(
        (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_n"))
    )
    return held.groupBy(
        *keys, F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), "_n", F.col("_first").alias("_skip")
    ).agg(F.collect_list("_rank").alias("_ranks"))


def _sorted(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _rank, _v) of the wanted ranks inside short intervals."""
    inside = rows.join(state.drop("_n"), keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    order = Window.partitionBy(*keys, "_lo", "_hi", "_skip").orderBy("_v")
    rank = (F.row_number().over(order) - 1 + F.col("_skip")).alias("_rank")
    ranked = inside.select(*keys, "_v", "_ranks", rank)
    return ranked.filter(F.array_contains("_ranks", F.col("_rank"))).select(*keys, "_rank", "_v")
