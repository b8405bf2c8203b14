"""Attribution of tree models: what each input adds to each forecast.

The nodes of a fitted ensemble become a table, one row per tree. A row goes down every tree
level by level; each step from a node to a child adds the difference of their values to the
input that was split on. The values of the roots are the base, and base plus contributions is
the forecast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.vectors import coerce_feature
from shelfcast.session import fresh_path

# nodes up to which the trees are sent to all tasks, at some 50 bytes a node
SMALL_NODES = 500_000


def tree_nodes(spark: SparkSession, ensemble) -> DataFrame:
    """(tree, node, feature, threshold, left, right, value, gain, n) of a fitted ensemble; a
    leaf has children -1. The table is the model's own saved form."""
    path = fresh_path(spark, "trees")
    ensemble.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("prediction").alias("value"),
        "gain",
        F.col("rawCount").alias("n"),
    )


def tree_weights(ensemble) -> list[float]:
    """Factors of the trees' values in the forecast: their weights, or shares of an average."""
    weights = [float(w) for w in ensemble.treeWeights]
    averaged = "RandomForest" in type(ensemble).__name__
    return [w / sum(weights) for w in weights] if averaged else weights


def gain_importance(nodes: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """(feature, gain): the impurity that splits on each input took away, weighted by rows,
    summed over all trees; inputs without a split have 0."""
    names = F.array(*[F.lit(f) for f in inputs])
    every = nodes.sparkSession.range(len(inputs)).select(F.col("id").cast("int").alias("feature"))
    gains = nodes.filter("left >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("n")).alias("gain"))
    return every.join(gains, "feature", "left").select(
        F.get(names, F.col("feature")).alias("feature"), F.coalesce("gain", F.lit(0.0)).alias("gain")
    )


def _walk(nodes: Column, x: Column, inputs: int, depth: int) -> Column:
    """(at, parts): the leaf a row ends in and the differences per input on the way."""
    start = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0.0), inputs).alias("parts"))

    def step(state: Column, _: Column) -> Column:
        node = F.get(nodes, state["at"])
        child = F.when(F.get(x, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])
        moved = F.struct(
            child.alias("at"),
            F.transform(
                state["parts"],
                lambda p, i: F.when(
                    i == node["feature"], p + F.get(nodes, child)["value"] - node["value"]
                ).otherwise(p),
            ).alias("parts"),
        )
        return F.when(node["left"] < 0, state).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), start, step)


def contributions(
    rows: DataFrame, ensemble, inputs: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """(keys, base, parts): the array `parts` has one number per input. `keys` name a row."""
    nodes = tree_nodes(rows.sparkSession, ensemble)
    weights = F.array(*[F.lit(w) for w in tree_weights(ensemble)])
    entry = F.struct("node", "feature", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(entry)).alias("nodes"))
    trees = trees.withColumn("weight", F.get(weights, F.col("tree")))
    if nodes.count() <= SMALL_NODES:
        trees = F.broadcast(trees)
    n_trees = len(ensemble.treeWeights)
    x = F.array(*[coerce_feature(F.col(c)) for c in inputs])
    each = rows.select(*keys, x.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
    depth = ensemble.getMaxDepth()
    walked = each.join(trees, "tree").select(
        *keys,
        "weight",
        (F.col("weight") * F.get("nodes", F.lit(0))["value"]).alias("_root"),
        _walk(F.col("nodes"), F.col("_x"), len(inputs), depth)["parts"].alias("_parts"),
    )
    return walked.groupBy(*keys).agg(
        F.sum("_root").alias("base"),
        F.array(*[F.sum(F.col("weight") * F.col("_parts")[i]) for i in range(len(inputs))]).alias("parts"),
    )


def mean_effects(parts: DataFrame, inputs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, mean_abs_effect) over the rows of `contributions`."""
    means = F.array(*[F.avg(F.abs(F.col("parts")[i])) for i in range(len(inputs))]).alias("e")
    wide = parts.groupBy(*keys).agg(means) if keys else parts.agg(means)
    names = F.array(*[F.lit(f) for f in inputs])
    rows = wide.select(*keys, F.posexplode("e").alias("i", "mean_abs_effect"))
    return rows.select(*keys, F.get(names, F.col("i")).alias("feature"), "mean_abs_effect")
