"""Operator 6: language by prediction by partial matching over byte contexts.

Each language has a tree of byte contexts up to order three, with counts from a sample of
its documents. A symbol costs -log2 of n/(total+kinds) in the longest context that has it;
every longer context first charges its escape, kinds/(total+kinds). The statistics are
frozen, so the code length of a text is a plain sum, exact for every byte: all 256 byte
values are symbols of their own. The contexts of two and three bytes are sorted tables of
those that were seen; shorter ones are one dense table.

A NULL text, and one without a letter, is `und` with score 0, as is every text if nothing
was learned. Equal code lengths go to the language that sorts first.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common
from shelfcast.llm.storage import share

SYMBOLS = 256
UNKNOWN = "und"
# bytes scored together; each takes some 60 bytes of a worker's memory
CHUNK = 250_000


def text_lower(text: str | None) -> bytes:
    return (text or "").lower().encode()


@dataclass(frozen=True)
class Level:
    """Costs in bits within contexts of `order` bytes, one column per language."""

    order: int
    seen: np.ndarray  # sorted codes of contexts and the byte after them
    cost: np.ndarray  # (seen, language)
    context: np.ndarray  # sorted codes of contexts
    escape: np.ndarray  # (context, language)


@dataclass(frozen=True)
class PpmModel:
    """Costs in bits, one column per language."""

    langs: list[str]
    shorter: np.ndarray  # cost within one byte of context, (256^2, language)
    levels: list[Level]  # of two bytes of context, and of three


def fit(counts: pd.DataFrame) -> PpmModel:
    """From rows (lang, gram, n): how often each four bytes, as one number, were seen."""
    langs = sorted(counts["lang"].unique())
    gram, n = counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    lang = np.searchsorted(langs, counts["lang"]) if langs else np.zeros(0, int)
    # below order 0: all bytes alike
    shorter, levels = np.full((1, len(langs)), np.log2(SYMBOLS)), []
    for order in range(4):
        code = gram & (1 << 8 * (order + 1)) - 1
        level = _level(order, code, lang, n, levels, shorter)
        if order < 2:
            shorter = code_lengths([level], shorter, np.arange(SYMBOLS ** (order + 1)))
        else:
            levels.append(level)
    single = [
        Level(x.order, x.seen, x.cost.astype(np.float32), x.context, x.escape.astype(np.float32))
        for x in levels
    ]
    return PpmModel(langs, shorter.astype(np.float32), single)


def _level(
    order: int,
    code: np.ndarray,
    lang: np.ndarray,
    n: np.ndarray,
    levels: list[Level],
    shorter: np.ndarray,
) -> Level:
    """The level of one order above those of the shorter contexts."""
    width = shorter.shape[1]
    seen, at = np.unique(code, return_inverse=True)
    table = np.zeros((len(seen), width))
    np.add.at(table, (at, lang), n)
    context, of = np.unique(seen >> 8, return_inverse=True)
    total, kinds = np.zeros((2, len(context), width))
    np.add.at(total, of, table)
    np.add.at(kinds, of, table > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
        own = -np.log2(table / (total + kinds)[of])
    # what is not in the context costs its escape and the cost one byte shorter
    fallback = escape[of] + code_lengths(levels, shorter, seen & (1 << 8 * order) - 1)
    return Level(order, seen, np.where(table > 0, own, fallback), context, escape)


def _find(values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each number in sorted values, and whether it is there."""
    if not len(values):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    at = np.minimum(np.searchsorted(values, asked), len(values) - 1)
    return at, values[at] == asked


def code_lengths(levels: list[Level], shorter: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Cost of the last byte of each code, by language."""
    if not levels:
        return shorter[code]
    level = levels[-1]
    at, there = _find(level.seen, code)
    cost = np.empty((len(code), shorter.shape[1]), dtype=shorter.dtype)
    cost[there] = level.cost[at[there]]
    new = np.flatnonzero(~there)
    if len(new):
        rest = code[new]
        part = code_lengths(levels[:-1], shorter, rest & (1 << 8 * level.order) - 1)
        at, there = _find(level.context, rest >> 8)
        part[there] += level.escape[at[there]]
        cost[new] = part
    return cost


def four_bytes(data: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, as one number."""
    wide = data.astype(np.int64)
    return wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]


def train(
    docs: DataFrame,
    train_docs: int = 500,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> PpmModel:
    """Count contexts in about `train_docs` documents of each language, whole texts.

    The sample is the share of hashed ids that gives this number; it is drawn where the rows
    are read. Rows without text or language are not used. The number of languages must fit
    the driver.
    """
    rows = docs.select(
        F.col(f"`{lang_col}`").alias("lang"),
        F.col(f"`{id_col}`").cast("string").alias("i"),
        F.col(f"`{text_col}`").alias("t"),
    ).where(F.col("lang").isNotNull() & F.col("t").isNotNull())
    there = rows.groupBy("lang").count().collect()
    share = F.lit(0.0)
    for lang, n in there:
        share = F.when(F.col("lang") == lang, train_docs / n).otherwise(share)
    sample = rows.where(common.in_sample(share, F.col("i"), F.length("t")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["t"]:
                blobs = [text_lower(t) for t in texts]
                for first, last in common.slices([len(b) for b in blobs], CHUNK):
                    data, _ = common.pack(blobs[first:last], b"    ")
                    gram, n = np.unique(four_bytes(data), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": gram, "n": n})

    grams = sample.select("lang", "t").mapInPandas(count, "lang string, gram long, n long")
    return fit(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())


class Scorer:
    """Code lengths of texts; made once per task."""

    def __init__(self, model: PpmModel):
        self.model = model

    def bits(self, blobs: list[bytes]) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(blobs), len(self.model.langs)))
        for first, last in common.slices([len(b) for b in blobs], CHUNK):
            part = blobs[first:last]
            data = np.frombuffer(b"   " + b"   ".join(part), dtype=np.uint8)
            sizes = np.array([len(b) for b in part])
            starts = np.cumsum(sizes + 3) - sizes - 3
            cost = code_lengths(self.model.levels, self.model.shorter, four_bytes(data))
            # positions of the white space between texts belong to no text
            for i, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
                out[first + i] = cost[start : start + size].sum(axis=0, dtype=np.float64)
        return out


class Judge:
    """Languages of texts; made once per task."""

    def __init__(self, model: PpmModel):
        self.langs = model.langs
        self.scorer = Scorer(model)
        self.letter = regex.compile(r"\p{L}").search

    def rows(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        judged = [i for i, t in enumerate(texts) if t and self.langs and self.letter(t)]
        if judged:
            bits = self.scorer.bits([text_lower(texts[i]) for i in judged])
            gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)
            scores = 1 / np.exp2(-gap).sum(axis=1)
            for i, best, score in zip(judged, bits.argmin(axis=1).tolist(), scores.tolist()):
                out[i] = self.langs[best], score
        return out


def predict(spark: SparkSession, model: PpmModel, text: Column | str) -> Column:
    """Struct (lang_pred, score): the shortest code and its share of the posterior."""
    shared = share(spark, model)
    kind = "lang_pred string, score double"

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = Judge(pickle.loads(shared.value))
        for texts in batches:
            parts = common.text_parts(texts, CHUNK)
            yield common.struct_array(kind, (judge.rows(part) for part in parts))

    return run(text)
