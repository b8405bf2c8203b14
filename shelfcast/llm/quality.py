"""Operator 4: document quality and toxicity by hierarchical empirical Bayes.

A document's evidence is a log-likelihood ratio: the margin of a logistic regression, less
the log-odds of the label in its training rows. Its features are words and marks that the text
has, and binned shares (of marks, capitals, distinct words); the elastic net leaves
words out that differ by chance.

Sites are judged from all of their documents: the expected share of positives of a host is
the mean posterior of its documents, shrunk to the global rate, and that of a path within the
host is shrunk to the host's. How many documents the prior of a level counts for follows from
the spread of its groups by the method of moments: the variance inside the paths over that
between the groups. A document's posterior starts from its path's rate, taken over the path's
and host's other documents, and adds its own evidence; so a sparse site hardly moves it, and
no document counts twice.

NULL and empty texts have no evidence and take the rate of their path. A NULL host or path
is a site of its own. Labels that are NULL are not learned from, repeated labels of a
document count once; without labels all rates are one half.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import share, stored

# documents a prior counts for, at least and at most (groups that do not differ)
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
BINS = 8
SHARES = 5
_WORD = regex.compile(r"[\p{L}\p{N}]+").findall
_CAPITALS = regex.compile(r"\p{Lu}").findall
_MARKS = regex.compile(r"[^\p{L}\p{N}\s.,]+").findall


def parts(text: str | None) -> tuple[list[str], list[str]]:
    """Words in lower case, and runs of marks, of a text."""
    return _WORD((text or "").lower()), _MARKS(text or "")


def features(text: str | None, vocabulary: dict[str, int]) -> list[int]:
    """Distinct features of a text: one bin for each share, then its known words and marks."""
    words, marks = parts(text)
    if not words and not marks:
        return []
    distinct = set(words)
    out = {vocabulary[p] for p in distinct.union(marks) if p in vocabulary}
    n = max(len(words), 1)
    letters = max(sum(map(len, words)), 1)
    shares = (
        min(1.0, len(marks) / n),
        min(1.0, len(_CAPITALS(text)) / letters),
        # texts repeat words the more the longer they are
        min(1.0, len(distinct) / n**0.85),
        min(1.0, letters / n / 16),
        min(1.0, np.log2(n + 1) / 14),
    )
    out.update(i * BINS + min(BINS - 1, int(s * BINS)) for i, s in enumerate(shares))
    return sorted(out)


@dataclass(frozen=True)
class Evidence:
    """Weight of each feature for each label, offsets, and the global rates of the labels."""

    vocabulary: dict[str, int]
    weights: np.ndarray
    offsets: list[float]
    rates: list[float]


def train(
    docs: DataFrame,
    labels: DataFrame,
    targets: Sequence[str] = ("quality", "toxic"),
    train_docs: int = 10_000,
    least_docs: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
) -> Evidence:
    """Learn from about `train_docs` labelled documents, at most twice as many.

    Words and marks are features if `least_docs` of those have them.
    """
    known = labels.select(
        F.col(f"`{label_id}`").alias("i"), *[F.col(f"`{t}`").cast("int").alias(f"y{k}") for k, t in enumerate(targets)]
    ).where(F.col("i").isNotNull())
    known = known.groupBy("i").agg(*[F.max(f"y{k}").alias(f"y{k}") for k in range(len(targets))])
    share = F.lit(train_docs / max(known.count(), 1))
    known = known.where(common.in_sample(share, F.col("i"))).limit(2 * train_docs)
    own = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    # bounded by the limit above
    rows = stored(own.join(F.broadcast(known), "i").drop("i"), "quality-sample")

    @F.udf("array<string>")
    def distinct_parts(text: str | None):
        words, marks = parts(text)
        return sorted(set(words).union(marks))

    # no more than the sample has
    found = rows.select(F.explode(distinct_parts("t")).alias("p")).groupBy("p").count()
    found = found.where(F.col("count") >= least_docs).select("p").orderBy("p").collect()
    first = SHARES * BINS
    vocabulary = {r[0]: first + i for i, r in enumerate(found)}
    size = first + len(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.udf(VectorUDT())
    def vector(text: str | None):
        found = features(text, shared.value)
        return SparseVector(size, found, [1.0] * len(found))

    rows = stored(rows.withColumn("x", vector("t")).drop("t"), "quality-features")
    weights, offsets, rates = np.zeros((size, len(targets))), [], []
    for k in range(len(targets)):
        mine = rows.where(F.col(f"y{k}").isin(0, 1))
        n, positive = mine.agg(F.count(F.lit(1)), F.sum(f"y{k}")).first()
        rates.append((float(positive or 0) + 1) / (n + 2))
        if positive and positive < n:
            learner = LogisticRegression(
                featuresCol="x", labelCol=f"y{k}", maxIter=60, regParam=0.004, elasticNetParam=0.8
            )
            fitted = learner.fit(mine)
            weights[:, k] = fitted.coefficients.toArray()
            # margin without the rate of the label: the evidence alone
            offsets.append(fitted.intercept - float(np.log(positive / (n - positive))))
        else:
            offsets.append(0.0)
    return Evidence(vocabulary, weights, offsets, rates)


def evidence(spark: SparkSession, model: Evidence, text: Column | str) -> Column:
    """Log-likelihood ratio of each label, as an array of doubles."""
    shared = share(spark, model)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = pickle.loads(shared.value)
        known, weights, offsets = fitted.vocabulary, fitted.weights, np.array(fitted.offsets)
        for texts in batches:
            found = [features(t, known) for t in texts]
            yield pd.Series([weights[f].sum(axis=0) + offsets if f else offsets * 0 for f in found])

    return run(text)


def _logit(rate: Column | float) -> Column:
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    return F.log(rate / (1 - rate))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strengths(paths: DataFrame, k: int) -> tuple[float, float]:
    """Documents that the priors of hosts and of paths count for, for target `k`.

    `paths` hold, for each path of each host, its documents `n` and the sums `s<k>` and `q<k>`
    of their posteriors and squares. The estimates are those of a nested analysis of variance.
    """
    hosts = paths.groupBy("host").agg(
        F.count(F.lit(1)).alias("p"),
        F.sum("n").alias("n"),
        F.sum(f"s{k}").alias("s"),
        F.sum(f"q{k}").alias("q"),
        F.sum(F.col(f"s{k}") ** 2 / F.col("n")).alias("ss"),
        F.sum(F.col("n") ** 2).alias("nn"),
    )
    row = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("p").alias("paths"),
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.sum("q").alias("q"),
        F.sum("ss").alias("path_ss"),
        F.sum(F.col("s") ** 2 / F.col("n")).alias("host_ss"),
        F.sum(F.col("nn") / F.col("n")).alias("path_nn"),
        F.sum(F.col("n") ** 2).alias("host_nn"),
    ).first()
    if not row["hosts"]:
        return MOST_STRENGTH, MOST_STRENGTH
    n, hosts_, paths_ = row["n"], row["hosts"], row["paths"]
    inside = (row["q"] - row["path_ss"]) / (n - paths_) if n > paths_ else 0.0

    def strength(squares: float, groups: int, size: float) -> float:
        """Prior documents of groups with `groups` degrees of freedom of `size` documents."""
        if groups <= 0 or size <= 0 or inside <= 0:
            return MOST_STRENGTH
        between = (squares / groups - inside) / size
        return min(max(inside / between, LEAST_STRENGTH), MOST_STRENGTH) if between > 0 else MOST_STRENGTH

    host = strength(
        row["host_ss"] - row["s"] ** 2 / n, hosts_ - 1, (n - row["host_nn"] / n) / max(hosts_ - 1, 1)
    )
    path = strength(
        row["path_ss"] - row["host_ss"], paths_ - hosts_, (n - row["path_nn"]) / max(paths_ - hosts_, 1)
    )
    return host, path


def score_documents(
    docs: DataFrame,
    model: Evidence,
    targets: Sequence[str] = ("quality", "toxic"),
    host_col: str = "source",
    path_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    strength: float | None = None,
) -> DataFrame:
    """(doc_id, host, path, one posterior `<target>_score` for each target) of every row.

    `strength` sets the documents that each prior counts for; else they are estimated.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{host_col}`").cast("string").alias("host"),
        F.col(f"`{path_col}`").cast("string").alias("path"),
        evidence(docs.sparkSession, model, F.col(f"`{text_col}`")).alias("e"),
    )
    rows = stored(rows, "evidence")
    own = [_sigmoid(F.col("e")[k] + _logit(rate)) for k, rate in enumerate(model.rates)]
    sums = [F.sum(x).alias(f"s{k}") for k, x in enumerate(own)]
    squares = [F.sum(x * x).alias(f"q{k}") for k, x in enumerate(own)]
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), *sums, *squares)
    paths = stored(paths, "paths")
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("host_n"), *[F.sum(f"s{k}").alias(f"h{k}") for k in range(len(targets))]
    )
    hosts = hosts.withColumnRenamed("host", "own_host")
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("own_host")))
    sites = sites.withColumnsRenamed({"host": "site_host", "path": "site_path"})
    sites = stored(sites.drop("own_host"), "sites")
    same = F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path"))
    joined = rows.join(sites, same)
    scores = []
    for k, (target, rate) in enumerate(zip(targets, model.rates)):
        of_host, of_path = (strength, strength) if strength is not None else strengths(paths, k)
        # what the other documents of the host say, and then those of the path
        prior = (F.col(f"h{k}") - own[k] + of_host * rate) / (F.col("host_n") - 1 + of_host)
        prior = (F.col(f"s{k}") - own[k] + of_path * prior) / (F.col("n") - 1 + of_path)
        scores.append(_sigmoid(F.col("e")[k] + _logit(prior)).alias(f"{target}_score"))
    return joined.select("doc_id", "host", "path", *scores)
