"""Time resampling with empty bins kept, daily roll-ups and pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import month_end, week_end


def resample(
    df: DataFrame,
    values: Sequence[str],
    freq: str = "W",
    how: str = "sum",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Bin by week (label Sunday) or month (label month end), per `keys`.

    Every bin between the first and the last one is present: an empty bin has sum 0
    and mean NULL.
    """
    if freq not in ("W", "M") or how not in ("sum", "mean"):
        raise ValueError(f"unknown freq/how {freq!r}/{how!r}")
    label = week_end(F.col("date")) if freq == "W" else month_end(F.col("date"))
    step = F.expr("interval 7 days") if freq == "W" else F.expr("interval 1 month")
    agg = F.sum if how == "sum" else F.avg
    bins = df.groupBy(*keys, label.alias("bin")).agg(*[agg(v).alias(v) for v in values])
    # one row per key: the spine is built from the first and last bin only
    ends = bins.groupBy(*keys).agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"))
    if freq == "M":
        # month starts step evenly; the label is the end of each
        starts = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), step)
        labels = F.transform(starts, lambda d: F.last_day(d))
    else:
        labels = F.sequence("lo", "hi", step)
    spine = ends.select(*keys, F.explode(labels).alias("bin"))
    out = spine.join(bins, [*keys, "bin"], "left")
    if how == "sum":
        out = out.na.fill(0.0, subset=list(values))
    return out.select(*keys, "bin", *values)


def daily_sales(panel: DataFrame) -> DataFrame:
    return panel.groupBy("store_nbr", "date", "family").agg(F.sum("sales").alias("sales"))


def daily_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("store_nbr", "date").agg(
        F.sum("transactions").alias("transactions")
    )


def sales_with_transactions(panel: DataFrame, transactions: DataFrame) -> DataFrame:
    return daily_sales(panel).join(
        daily_transactions(transactions), ["store_nbr", "date"], "left"
    )


def impute_transactions(
    base: DataFrame, min_tx: int = 50, max_tx: int = 1200, units_per_ticket: float = 1.4
) -> DataFrame:
    """Ticket count per store and day; a missing or non-positive one is estimated
    from the units sold, then clipped."""
    day = base.groupBy("store_nbr", "date").agg(
        F.sum("sales").alias("units"), F.max("transactions").alias("transactions")
    )
    guess = F.greatest(
        F.lit(1), F.floor(F.floor("units") / units_per_ticket).cast("int")
    )
    known = F.col("transactions") > 0
    count = F.when(known, F.col("transactions")).otherwise(guess)
    clipped = F.least(F.greatest(count, F.lit(float(min_tx))), F.lit(float(max_tx)))
    return day.withColumn("n_tickets", clipped.cast("int"))


def gain_heatmap(
    df: DataFrame, rows: str, columns: str, value: str, labels: Sequence[str | int] | None = None
) -> DataFrame:
    """Mean of `value` by rows x columns, absent cells 0.

    Without `labels` the planner looks up the distinct ones, which become columns.
    """
    cells = df.groupBy(rows)
    cells = cells.pivot(columns, list(labels)) if labels else cells.pivot(columns)
    return cells.agg(F.avg(value)).na.fill(0.0)


def gain_cells(df: DataFrame, rows: DataFrame, columns: DataFrame, value: str) -> DataFrame:
    """The heatmap in long form: mean of `value` for every row label and column label.

    Both label lists are short: stores and families, whatever the number of sales.
    """
    row, column = rows.columns[0], columns.columns[0]
    means = df.groupBy(row, column).agg(F.avg(value).alias("gain"))
    labels = columns.agg(F.collect_set(column)).scalar()
    cells = rows.select(row, F.explode(labels).alias(column))
    return cells.join(means, [row, column], "left").na.fill(0.0, subset=["gain"])


def _dimensions() -> Column:
    """Array of (dimension, value) of a row: weekday, month and promotion."""
    dimensions = {
        "dayofweek": F.weekday("date"),
        "month": F.month("date"),
        "promo": (F.col("onpromotion") > 0).cast("int"),
    }
    return F.array(*[F.struct(F.lit(n).alias("dimension"), v.alias("value")) for n, v in dimensions.items()])


# The distribution function of a Poisson variable of mean 1 at 0, 1, 2, ...
POISSON_ONE = (0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815, 0.999916759)


def poisson_weights(row_id: Column, replicates: int) -> list[Column]:
    """How often a row is drawn in each replicate of a bootstrap: Poisson numbers of mean 1.

    They follow from the row's id alone (eight hexadecimal digits of an MD5 sum each), so they
    are the same in every run and on any number of machines.
    """
    out = []
    for k in range(replicates):
        text = F.md5(F.concat_ws("-", row_id.cast("string"), F.lit(str(k // 4))).cast("binary"))
        digits = F.conv(F.substring(text, k % 4 * 8 + 1, 8), 16, 10).cast("double")
        share = digits / float(1 << 32)
        steps = [F.when(share >= p, 1.0).otherwise(0.0) for p in POISSON_ONE]
        out.append(sum(steps[1:], steps[0]))
    return out


def bootstrap_profiles(
    df: DataFrame, replicates: int = 200, level: float = 0.95, row_id: str = "id"
) -> DataFrame:
    """Mean sales by weekday, month and promotion, with a bootstrap interval.

    Every row is weighted once per replicate and dimension; all replicates are sums of one
    grouped pass with a map-side part, and what is shuffled has the size of the replicates.
    """
    weights = poisson_weights(F.col(row_id), replicates)
    rows = df.filter("sales IS NOT NULL").select("sales", F.explode(_dimensions()).alias("d"), F.array(*weights).alias("w"))
    drawn = [F.sum(F.col("w")[k]) for k in range(replicates)]
    totals = [F.sum(F.col("w")[k] * F.col("sales")) for k in range(replicates)]
    sums = rows.groupBy("d.dimension", "d.value").agg(
        F.avg("sales").alias("mean_sales"),
        F.count("sales").alias("n"),
        F.array(*[F.try_divide(t, n) for t, n in zip(totals, drawn)]).alias("means"),
    )
    tail = (1 - level) / 2
    means = sums.select("dimension", "value", "mean_sales", "n", F.explode("means").alias("m"))
    return means.groupBy("dimension", "value", "mean_sales", "n").agg(
        F.percentile("m", F.lit(tail)).alias("ci_low"), F.percentile("m", F.lit(1 - tail)).alias("ci_high")
    )


def sales_profiles(df: DataFrame) -> DataFrame:
    """Mean sales by weekday, month and promotion, with a normal 95 % interval.

    One pass: each row counts once per dimension, and the partial aggregate leaves
    a few dozen rows per task to shuffle.
    """
    half = F.lit(1.96) * F.stddev_samp("sales") / F.sqrt(F.count("sales"))
    return (
        df.select("sales", F.explode(_dimensions()).alias("d"))
        .groupBy("d.dimension", "d.value")
        .agg(
            F.avg("sales").alias("mean_sales"),
            F.count("sales").alias("n"),
            (F.avg("sales") - half).alias("ci_low"),
            (F.avg("sales") + half).alias("ci_high"),
        )
    )


def ticket_items(lines: DataFrame, ticket: str) -> DataFrame:
    """Items per ticket and family."""
    return lines.groupBy(ticket, "family").agg(F.count(F.lit(1)).alias("qty"))
