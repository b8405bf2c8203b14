"""Cleaning of a corpus in stages; each reads what the stage before it wrote.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of `docs`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, decontaminate, langid, lines, simhash
from shelfcast.llm.common import doc_remainder, free_name, read_table
from shelfcast.llm.queries import tokenizer_path
from shelfcast.session import fresh_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; the predicted language and its score decide nothing more.

    NULL, empty and letterless texts go. Rows are judged one by one, repeated ones alike.
    """
    model = langid.train(docs.where(doc_remainder("doc_id", 3) != 1))
    return docs.where(langid.predict(spark, model, F.col("text"))["lang_pred"] != langid.UNKNOWN)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines; documents that lose all lines go.

    NULL and empty texts stay as they are. Rows equal in id and text share their fate; of the
    same lines those of the smaller id stay, NULL ids come last.
    """
    kept, removed = (free_name(name, docs.columns) for name in ("kept", "removed"))
    found = lines.dedup_lines(docs, kept=kept, removed=removed)
    changed = F.col(removed) > 0
    found = found.where((F.trim(kept) != "") | ~changed)
    found = found.withColumn("text", F.when(changed, F.col(kept)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        counted = F.length(kept).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(changed, counted).otherwise(F.col("n_chars")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints over four-word shingles, repeats
    included, differ in four bits or fewer: that of the smallest id.

    NULL and empty texts are one group, as are equal texts; NULL ids come last.
    """
    return simhash.keep_one(docs, shingle=4, bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs.

    NULL and empty texts have none and stay. Rows are judged one by one, repeated ones alike.
    """
    benchmark = decontaminate.Benchmark(read_table(spark, sf_dir, "benchmark"))
    return docs.where(~decontaminate.contaminated(spark, benchmark, F.col("text")))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text of every row.

    A NULL text is the empty text and has no tokens.
    """
    model = bpe.BpeModel.from_file(tokenizer_path())
    digest = bpe.encode_digest(spark, model, F.col("text")).alias("d")
    return docs.select("doc_id", digest).select("doc_id", "d.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

# code lengths, fingerprints and token ids have no SQL; tests compare with plain Python
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    last = len(STAGES) - 1
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < last:
            path = fresh_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
