"""Operator 9: secrets by fixed patterns and by two character Markov models.

One model is trained on values that the patterns call secret, the other on ordinary words
and identifiers. A token of TOKEN characters that no pattern covers is a secret if it holds
a digit and a letter and its log-likelihood ratio per character is MARGIN or more.

NULL and empty texts have no spans. Without labelled values the random model is uniform.
Spans count code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import share

# The kinds in their order, and the characters of tokens
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEARNED = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start and then by kind."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for kind, start, end in spans])


def labelled_tokens(text: str) -> Iterator[tuple[int, str]]:
    """(1, a secret value) and (0, an ordinary token) of a text."""
    spans = base_spans(text)
    for kind, start, end in spans:
        value = text[start:end]
        if kind == "assign":
            value = ASSIGN.match(value)[2]
        yield 1, value
    covered = [(start, end) for _, start, end in spans]
    for m in LEARNED.finditer(text):
        if not any(m.start() < end and start < m.end() for start, end in covered):
            yield 0, m[0]


@dataclass(frozen=True)
class MarkovPair:
    """Log-likelihood ratio of each step; row 0 is the start of a token."""

    ratio: np.ndarray

    @staticmethod
    def from_counts(counts: list[tuple[int, int, int, int]]) -> MarkovPair:
        """From (label, previous, next, count) with positions in the alphabet, 0 at the start."""
        n = len(ALPHABET)
        table = np.zeros((2, n + 1, n))
        for label, before, after, count in counts:
            table[label, before, after - 1] += count
        # what was not seen is as likely as any character in random strings, and as likely as
        # the character by itself in ordinary ones
        single = (table[0].sum(axis=0) + 0.5) / (table[0].sum() + 0.5 * n)
        prior = np.stack((np.tile(5 * single, (n + 1, 1)), np.ones((n + 1, n))))
        table += prior
        logs = np.log(table / table.sum(axis=2, keepdims=True))
        return MarkovPair(logs[1] - logs[0])

    def score(self, token: str) -> float:
        """Mean log-likelihood ratio per character."""
        before, total = 0, 0.0
        for c in token:
            after = ALPHABET.index(c) + 1
            total += self.ratio[before, after - 1]
            before = after
        return total / len(token)


def train(
    docs: DataFrame, train_docs: int = 4000, id_col: str = "doc_id", text_col: str = "text"
) -> MarkovPair:
    """Fit both models on about `train_docs` documents.

    The sample is the share of hashed ids that gives this number, drawn where the rows are
    read; only counts of character pairs leave the tasks.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t")
    ).where(F.col("t").isNotNull())
    share = F.lit(train_docs / max(docs.count(), 1))
    sample = rows.where(common.in_sample(share, F.col("i"), F.length("t"))).select("t")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {c: i + 1 for i, c in enumerate(ALPHABET)}
        for batch in batches:
            table = np.zeros((2, len(ALPHABET) + 1, len(ALPHABET) + 1), dtype=np.int64)
            for text in batch["t"]:
                for label, token in labelled_tokens(text):
                    before = 0
                    for c in token:
                        after = place.get(c, 0)
                        if after:
                            table[label, before, after] += 1
                        before = after
            label, before, after = np.nonzero(table)
            yield pd.DataFrame(
                {"label": label, "before": before, "after": after, "n": table[label, before, after]}
            )

    steps = sample.mapInPandas(count, "label long, before long, after long, n long")
    rows = steps.groupBy("label", "before", "after").agg(F.sum("n").alias("n")).collect()
    return MarkovPair.from_counts([tuple(r) for r in rows])


def find_spans(text: str, model: MarkovPair, margin: float) -> tuple[list[Span], list[Span]]:
    """(spans of the fixed patterns, all spans)."""
    base = base_spans(text)
    added: list[Span] = []
    for m in TOKEN.finditer(text):
        token = m[0]
        if not any("0" <= c <= "9" for c in token) or not any(c.isalpha() for c in token):
            continue
        if any(m.start() < end and start < m.end() for _, start, end in base):
            continue
        if model.score(token) >= margin:
            added.append(("markov", *m.span()))
    return base, in_order(base + added) if added else base


def _per_text(
    spark: SparkSession, model: MarkovPair, kind: str, margin: float, row: Callable
) -> Callable:
    shared = share(spark, model)

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = pickle.loads(shared.value)
        names = [c.split()[0] for c in re.split(r", (?![^<]*>)", kind)]
        for texts in batches:
            rows = [row(*find_spans(t or "", fitted, margin)) for t in texts]
            yield pd.DataFrame(rows, columns=names)

    return run


MARGIN = math.log(2)


def secret_spans(
    spark: SparkSession, model: MarkovPair, text: Column | str, margin: float = MARGIN
) -> Column:
    """Struct with `found`, an array of (kind, start, end)."""
    kind = "found array<struct<kind:string,start:int,end:int>>, n_found int"
    return _per_text(spark, model, kind, margin, lambda base, spans: (spans, len(spans)))(text)


def secret_digest(
    spark: SparkSession, model: MarkovPair, text: Column | str, margin: float = MARGIN
) -> Column:
    """Struct (n_assign, n_access, n_hex, base_sha256, spans)."""

    def row(base: list[Span], spans: list[Span]):
        counts = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
        return *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)

    kind = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return _per_text(spark, model, kind, margin, row)(text)
