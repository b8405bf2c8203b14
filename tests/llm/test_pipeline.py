"""The pipeline against plain Python, on awkward and on empty tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from shelfcast.llm import bpe
from shelfcast.llm.queries import QUERIES, tokenizer_path
from tests.llm import twins

PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = twins.rows_of(twins.awkward_texts())
    rows += [(300, f"some words before {PASSAGE} and after it", "en", None, None, None)]
    spark.createDataFrame(rows, twins.SCHEMA).write.parquet(str(path / "documents.parquet"))
    items = spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string")
    items.write.parquet(str(path / "benchmark.parquet"))
    vectors = spark.createDataFrame([(50, [1.0, 2.0], 1), (51, None, None)], "vec_id long, embedding array<float>, label int")
    vectors.write.parquet(str(path / "embeddings.parquet"))
    labels = [(i, i % 2, None if i == 3 else 0) for i in (0, 1, 2, 3, 4, 9, 9, 12, 7000)] + [(None, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labels.write.parquet(str(path / "labels.parquet"))
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    columns, before, results = docs.columns, docs.count(), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder)).cache()
        results.append(out.collect())
        assert len(results[-1]) <= before
        before = len(results[-1])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = spark.createDataFrame(results[-1], docs.schema)
    language, deduped, single, clean, encoded = results
    assert all(any(c.isalpha() for c in r["text"]) for r in language)
    rows = [(twins.order_id(r["doc_id"]), r["text"]) for r in language]
    want = [(i, kept) for (i, t), (kept, n) in zip(rows, twins.kept_lines(rows, 20)) if kept.strip(" ") or not n]
    assert sorted((twins.order_id(r["doc_id"]), r["text"]) for r in deduped) == sorted(want)
    assert {r["text"] for r in single} <= {r["text"] for r in deduped}
    assert len({r["text"] for r in single}) == len(single)
    gone = [r["doc_id"] for r in single if twins.window_hits(r["text"], [("1", PASSAGE)])[1]]
    assert gone == [300]
    assert sorted(str(r["doc_id"]) for r in clean) == sorted(str(r["doc_id"]) for r in single if r["doc_id"] != 300)
    coded = bpe.Encoder(bpe.BpeModel.from_file(tokenizer_path())).encoded([r["text"] for r in clean])
    want = [(str(r["doc_id"]), n, twins.sha(ids), twins.sha(d)) for r, (ids, n, d) in zip(clean, coded)]
    assert sorted((str(r[0]), *r[1:]) for r in encoded) == sorted(want)


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(folder))
    assert sorted(map(str, corpus_pipeline.run(spark, str(folder)).collect())) == sorted(map(str, docs.collect()))


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, folder, tmp_path, name):
    for table in ("documents", "benchmark", "embeddings", "labels"):
        spark.read.parquet(str(folder / f"{table}.parquet")).limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    run = corpus_pipeline.run if name == "pipeline" else QUERIES[name]
    assert run(spark, str(tmp_path)).count() == 0


def test_query_columns(spark, folder):
    want = {
        "op1": ["query_id", "rank", "vec_id", "score"],
        "op2": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op3": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op4": ["doc_id", "quality_score", "toxic_score", "keep"],
        "op5": ["doc_id", "fingerprint", "component_id"],
        "op6": ["doc_id", "held_out", "lang_pred", "score"],
        "op7": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op8": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op11": ["vec_id", "n_links", "component_id", "kept"],
        "op12": ["item_id", "rank", "doc_id", "score"],
        "op13": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        "op9": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    }
    for name, run in QUERIES.items():
        found = run(spark, str(folder))
        if name.split("_")[0] in want:
            assert found.columns == want[name.split("_")[0]]
        rows = found.collect()
        if "doc_id" in found.columns and "item_id" not in found.columns:
            assert len(rows) == spark.read.parquet(str(folder / "documents.parquet")).count()
