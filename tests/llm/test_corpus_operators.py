"""Operators that compare documents: n-grams, suffixes, SimHash, lines, neighbours."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import ann, common, eliasfano, lines, ngram, simhash, substrings, suffixes
from shelfcast.llm.common import doc_remainder
from shelfcast.llm.components import connected
from shelfcast.llm.queries import QUERIES, SQL
from tests.llm import twins

ROWS = twins.rows_of(twins.awkward_texts())
# the default, before a test sets another
BANDS = simhash.similar.__defaults__[-2]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, twins.SCHEMA).repartition(3)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for n in (1, 5, 40, 2000):
        data = rng.integers(97, 99, n).astype(np.uint8)
        data[n // 2 :] = data[: n - n // 2]
        text = data.tobytes()
        order = suffixes.suffix_array(data)
        assert [text[i:] for i in order] == sorted(text[i:] for i in range(n))
        shared = suffixes.common_prefixes(data, order, 50, lane=16)
        for i in range(1, n):
            a, b = text[order[i - 1] :], text[order[i] :]
            want = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert min(shared[i], 50) == min(want, 50)


def test_suffix_array_sorts_values_in_place(monkeypatch):
    """Ties are sorted by one value of a suffix and its ranks where that fits, and as pairs of an
    order and a key beyond it."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:] = data[:1500]
    text = data.tobytes()
    want = sorted(range(3000), key=lambda i: text[i:])
    argsort, sizes = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda x, **more: sizes.append(len(x)) or argsort(x, **more))
    assert suffixes.suffix_array(data).tolist() == want and sizes == [3000]
    by_ranks = suffixes._by_ranks
    # 22 bits a rank do not fit three times
    keys = lambda members, key, bits: by_ranks(members, (key >> np.uint64(bits) << np.uint64(22)) | key & np.uint64((1 << bits) - 1), 22)
    monkeypatch.setattr(suffixes, "_by_ranks", keys)
    assert suffixes.suffix_array(data).tolist() == want and len(sizes) > 3


def test_powers_of_the_rolling_sums():
    common._POWERS.clear()
    up, down = common.step_powers(300_000)
    assert len(up) >= 300_000 and up[0] == down[0] == 1
    assert (up[1:] == up[:-1] * common._STEP).all() and (up * down == 1).all()


def test_merge_least():
    shards = [(np.array(a, dtype="S2"), np.array(n)) for a, n in ((["aa", "bb"], [5, 2]), (["bb", "cc"], [1, 9]), (["aa"], [7]))]
    assert [x.tolist() for x in suffixes.merge_least(shards)] == [[5, 1], [1, 9], [5]]


@pytest.mark.parametrize("shard, part, crowd", [(4_000_000, 1_000_000, 64), (9_000, 3_000, 2)])
def test_repeats_equal_brute_force(docs, shard, part, crowd):
    found = substrings.remove_repeats(docs, shard_bytes=shard, part_bytes=part, crowd=crowd)
    got = sorted((str(r["doc_id"]), r["n_bytes"], bytes(r["kept"]), list(zip(r["starts"], r["ends"]))) for r in found.collect())
    texts = [(r[1] or "").encode() for r in ROWS]
    marks = twins.covered([twins.order_id(r[0]) for r in ROWS], texts, 50)
    want = []
    for row, text, mark in zip(ROWS, texts, marks):
        edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + mark + b"\0", dtype=np.int8)))
        kept = bytes(b for b, m in zip(text, mark) if not m)
        want.append((str(row[0]), len(text), kept, list(zip(edges[0::2].tolist(), edges[1::2].tolist()))))
    assert got == sorted(want)
    assert any(spans for *_, spans in got)


def test_each_stretch_is_sent_once():
    """Of four shards with one seed, three have the same stretch: one of them sends it, and the
    seed stands amid two stretches, not four."""
    marks = [5, 7, 5, 5]
    part = pd.DataFrame({
        "shard": range(4),
        "bucket": 0,
        "seeds": [common.pack_sorted(np.array([9], dtype=np.uint32))] * 4,
        "marks": [common.pack_planes(np.array([m], dtype=np.uint64), substrings.MARK_BYTES) for m in marks],
        "many": [b"\0"] * 4,
    })
    for crowd, dense in ((2, 1), (3, 0)):
        flags = substrings._shared_rows(part, crowd)["flags"]
        bits = [np.unpackbits(np.frombuffer(f, dtype=np.uint8), count=3).tolist() for f in flags]
        assert bits == [[1, dense, 1], [1, dense, 1], [1, dense, 0], [1, dense, 0]]


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, universe in ((0, 10), (1, 1), (5, 5), (1000, 1 << 32), (1000, 1200), (300, 1 << 48)):
        values = np.sort(rng.integers(0, universe, n))
        coded = eliasfano.EliasFano.encode(values, universe)
        asked = np.concatenate((values, rng.integers(0, universe, 500)))
        assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
        assert ((coded.find(asked) >= 0) == np.isin(asked, values)).all()
        if n:
            assert (coded.value(np.arange(n)) == values).all()


def test_many_searches_select_all_zeros_at_once(monkeypatch):
    """A search for as many values as a trie's level holds selects no zero by itself."""
    rng = np.random.default_rng(7)
    for n, universe in ((1, 1), (1000, 1 << 32), (1000, 1200)):
        values = np.sort(rng.integers(0, universe, n))
        coded = eliasfano.EliasFano.encode(values, universe)
        asked = np.concatenate((values, rng.integers(0, universe, 500)))
        one_by_one = [int(coded.find(asked[i : i + 1])[0]) for i in range(len(asked))]
        with monkeypatch.context() as m:
            m.setattr(eliasfano.EliasFano, "_select_zero", None)
            assert coded.find(asked).tolist() == one_by_one


def test_packed_runs():
    """Runs come back as they were; planes of zeros take no bytes."""
    rng = np.random.default_rng(8)
    values = rng.integers(0, 1 << 20, 1000, dtype=np.uint64)
    values[100:300] = 0
    runs = [(0, 100), (100, 300), (300, 300), (300, 1000)]
    blobs = common.squeeze_runs(values, 6, runs)
    assert len(blobs[1]) == 4 * 7
    got, counts = common.spread_runs(blobs, 6, np.uint64)
    assert got.tolist() == values.tolist() and counts.tolist() == [j - i for i, j in runs]
    assert [common.spread_out(b, 6) for b in blobs] == [common.pack_planes(values[i:j], 6) for i, j in runs]
    assert len(common.squeeze(bytes(60), 6)) == 4 * 7 and common.spread_out(common.squeeze(bytes(60), 6), 6) == bytes(60)
    ordered = np.concatenate([np.sort(values[i:j]) for i, j in runs])
    got, places = ngram._unsorted(ngram._sorted(ordered, runs))
    assert got.tolist() == ordered.tolist() and places == runs


def test_word_hashes():
    """Equal words have equal hashes wherever they stand, others do not."""
    words = [b"", b"a", b"b", b"a\0", *(bytes([97 + i % 3]) * i for i in range(2, 200)), b"x" * 64 + b"y", b"x" * 65]
    data, starts = common.pack([*words, *words[::-1]])
    sizes = np.array([len(w) for w in [*words, *words[::-1]]])
    found = common.word_hashes(data, starts, starts + sizes)
    assert (found[: len(words)] == found[len(words) :][::-1]).all()
    assert len(set(found.tolist())) == len(set(words))


def test_own_triples_score_held_out_texts():
    """A triple that only one shard has scores its held-out texts as well as the others."""
    texts = [b"a b c", b"a b c", b"a b d"]
    part = pd.DataFrame({"doc_id": range(3), "text": common.pressed(pd.Series([t.decode() for t in texts])), "trains": [True, False, True], "shard": 0})
    answers = ngram._counts_for(ngram._ask_words(part, 1))
    answers.insert(0, "n", 0)
    shard = lambda: ngram.Shard(part, answers, 1, ngram.MASS, ngram.SPLIT)
    answers = pd.concat([answers, ngram._codes_for(shard().ask_pairs(), 1, ngram.MASS, True)])
    assert not len(shard().ask_triples())
    found = shard().scores(3)
    assert found["score"][0] == found["score"][1] and found["score"][0] == found["score"][2]


@pytest.mark.parametrize("shard", [4_000_000, 9_000])
def test_ngram_scores_equal_brute_force(docs, shard):
    found = ngram.score_documents(docs, doc_remainder("doc_id", 10) != 0, shard_bytes=shard)
    key = lambda r: (str(r[0]), r[2], r[3], round(r[6], 6))
    got = sorted((tuple(r) for r in found.collect()), key=key)
    want = twins.ngram_scores([r[:2] for r in ROWS], ngram.MASS)
    want = sorted(((r[0], not w[0], *w[1:]) for r, w in zip(ROWS, want)), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("shard", [4_000_000, 9_000])
def test_ngram_scores_of_order_three_equal_brute_force(docs, shard):
    """Triples of one shard alone and of several, in tries of three levels."""
    training = doc_remainder("doc_id", 10) != 0
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6), round(r[6], 6))
    found = ngram.score_documents(docs, training, shard_bytes=shard, order=3, split=4 if shard < 10_000 else ngram.SPLIT)
    got = sorted((tuple(r) for r in found.collect()), key=key)
    want = twins.ngram_scores([r[:2] for r in ROWS], ngram.MASS)
    scores = twins.ngram_scores_of_three([r[:2] for r in ROWS], ngram.MASS)
    assert any(s > w[5] + 1 for s, w in zip(scores, want))
    want = [(r[0], not w[0], *w[1:5], s) for r, w, s in zip(ROWS, want, scores)]
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_op2_scores_by_three_levels(spark, tmp_path):
    """Held-out texts of the same pairs, of which one has the triples of the training text."""
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    train = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10][:40]
    rows = [(i, "a b c a x b d x b d a") for i in train] + [(held[0], "x b c"), (held[1], "x b d")]
    rows += [(i + 100, "x b c a b d a") for i in train if zlib.crc32(str(i + 100).encode()) % 10]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    score = {r["doc_id"]: r["score"] for r in QUERIES["op2_ngram_score"](spark, str(tmp_path)).collect()}
    want = twins.ngram_scores_of_three(rows, ngram.MASS)
    assert [score[r[0]] for r in rows] == pytest.approx(want, rel=1e-9)
    two = [w[5] for w in twins.ngram_scores(rows, ngram.MASS)]
    assert max(abs(a - b) for a, b in zip(two, want)) > 0.01


def test_trie_of_three_levels():
    rng = np.random.default_rng(4)
    bits = [16, 16, 24]
    key = np.concatenate([rng.integers(0, 1 << 56, 300, dtype=np.uint64), np.arange(300, dtype=np.uint64) * np.uint64(1 << 22)])
    key = np.unique(np.concatenate((key, key ^ np.uint64(1))))
    codes = rng.integers(1, 255, len(key))
    trie = eliasfano.Trie.of(ngram.split(key, bits), bits, codes)
    asked = np.concatenate((key, key ^ np.uint64(2), key ^ np.uint64(1 << 30)))
    want = dict(zip(key.tolist(), codes.tolist()))
    assert trie.codes_of(*ngram.split(asked, bits)).tolist() == [want.get(k, 0) for k in asked.tolist()]
    none = eliasfano.Trie.of(ngram.split(key[:0], bits), bits, codes[:0])
    assert not none.codes_of(*ngram.split(asked, bits)).any()


def test_ngram_scores_are_probabilities():
    """Codes never stand for more than what they were made of, so p is in (0, 1] and sums to
    one at most, also after a context that one successor always follows."""
    rng = np.random.default_rng(1)
    counts = np.unique(np.concatenate([np.arange(1, 3000), rng.integers(1, 1 << 31, 3000)]))
    kept = ngram.quantised(ngram.quantise(counts))
    assert (kept <= counts).all() and (kept > counts * 2 ** (-1 / 8) - 1e-9).all()
    assert ngram.quantised(ngram.quantise(np.array([0, 1, 2]))).tolist() == [0, 1, 2]
    p = np.concatenate((np.exp2(-rng.random(3000) * 31), np.exp2(-np.arange(31.0))))
    kept = ngram.probabilities(ngram.probability_codes(p))
    assert (kept <= p).all() and (kept > p * 2 ** (-1 / 8) - 1e-12).all()
    assert ngram.probabilities(ngram.probability_codes(np.array([1e-12, 1.0]))).tolist() == [0, 1]
    for share in (0.5, 0.02):
        for _ in range(30):
            follows = rng.integers(0, 100_000, 40) * (rng.random(40) < share)
            follows[0] += 1
            words = follows + rng.integers(0, 1000, 40)
            floor = words.sum() + 0.1 * 41
            alone = (words + 0.1) / floor
            least = (ngram.quantised(ngram.quantise(words)) + 0.1) / floor
            context = follows.sum() + ngram.MASS
            codes = ngram.probability_codes((follows + ngram.MASS * least) / context)
            codes[follows == 0] = 0
            after = np.maximum(ngram.probabilities(codes), ngram.MASS * alone / context)
            assert (after > 0).all() and after.sum() <= 1


def test_trie_of_any_width():
    rng = np.random.default_rng(3)
    for bits in (24, 32):
        key = np.unique(rng.integers(0, 1 << 2 * bits, 500, dtype=np.uint64) | np.uint64(1))
        key = np.unique(np.concatenate((key, key[:50] ^ np.uint64(1))))
        shift, keep = np.uint64(bits), np.uint64((1 << bits) - 1)
        contexts, sizes = np.unique(key >> shift, return_counts=True)
        codes = rng.integers(1, 255, len(key))
        trie = eliasfano.Trie(contexts, sizes, key & keep, codes, bits)
        asked = np.concatenate((key, key ^ np.uint64(2)))
        want = dict(zip(key.tolist(), codes.tolist()))
        assert trie.codes_of(asked >> shift, asked & keep).tolist() == [want.get(k, 0) for k in asked.tolist()]


def test_ngram_without_training(docs):
    rows = ngram.score_documents(docs, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows} == {(0, 0, 0.0, 0.0)}


@pytest.mark.parametrize("crowd", [simhash.CROWD, 3])
def test_fingerprints_and_components(spark, docs, crowd, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (4, crowd))
    found = simhash.near_duplicates(docs).collect()
    prints = [twins.fingerprint(r[1]) for r in ROWS]
    roots = twins.groups(len(ROWS), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 4)
    least = {}
    for r, root in zip(ROWS, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    want = [(str(r[0]), p, least.get(root)) for r, p, root in zip(ROWS, prints, roots)]
    got = [(str(r["doc_id"]), r["fingerprint"] % (1 << 64), r["component_id"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_links_of_random_values(spark):
    """No link between different values is lost, in calm keys and in crowded ones."""
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(120)]
    for _ in range(200):
        values.append(rng.choice(values) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in set(values))
    nodes = spark.createDataFrame([(v,) for v in signed], "node long")
    roots = twins.groups(len(signed), lambda i, j: bin((signed[i] ^ signed[j]) % (1 << 64)).count("1") <= 4)
    want = {v: signed[r] for v, r in zip(signed, roots)}
    for crowd in (2, 2000):
        got = {r["node"]: r["root"] for r in connected(simhash.links(nodes, 4, crowd)).collect()}
        assert {v: got.get(v, v) for v in signed} == want


def test_keys_always_meet():
    rng = random.Random(5)
    for n, agree in ((10, 1), (50_000, 2), (10**9, 4)):
        keys = simhash.key_bits(n, 4)
        assert len(keys[0]) >= 64 * agree // (4 + agree) - agree
        for _ in range(300):
            differ = set(rng.sample(range(64), 4))
            assert any(not differ & set(k) for k in keys)


def test_similar_documents(spark, docs, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    rows, want = [], []
    for i in range(30):
        text = rng.choices(words, k=200)
        rows.append((10 * i, " ".join(text)))
        for j in range(1, 4):
            copy = list(text)
            for at in rng.sample(range(200), 2):
                copy[at] = "new"
            rows.append((10 * i + j, " ".join(copy)))
        want.append(10 * i)
    base = spark.createDataFrame(rows, "doc_id long, text string")
    for crowd in (2, 2000):
        monkeypatch.setattr(simhash.similar, "__defaults__", (16, 40, crowd))
        kept = simhash.keep_one(base, shingle=5, similarity=0.8, words=8)
        assert sorted(r["doc_id"] for r in kept.collect()) == want
    monkeypatch.undo()
    assert simhash.similar.__defaults__[-2] == BANDS == 80
    once = simhash.keep_one(docs, shingle=5, similarity=0.8, words=8).collect()
    assert len({r["text"] or "" for r in once}) == len(once)
    assert {r["doc_id"] for r in once if not (r["text"] or "").strip()} == {0}


def _jaccard_cases():
    """Pairs of texts whose five-word Jaccard similarity runs from 0.7 to 0.9, and of texts
    that share a much repeated phrase only."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    rows = []
    while len(rows) < 800:
        text = rng.choices(words, k=300)
        copy = list(text)
        for at in rng.sample(range(300), rng.randint(3, 12)):
            copy[at] = "new"
        sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (text, copy)]
        if 0.7 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) <= 0.9:
            rows += [(len(rows) + j, " ".join(t)) for j, t in enumerate((text, copy))]
    phrase = "one two three four five six seven eight " * 60
    return rows + [(1000 + i, phrase + " ".join(rng.choices(words, k=40))) for i in range(4)]


@pytest.mark.parametrize("crowd", [2, 2000])
def test_links_have_the_jaccard_similarity(spark, monkeypatch, crowd):
    rows = _jaccard_cases()
    sets = {}
    for i, text in rows:
        parts = text.split()
        sets[i] = {tuple(parts[j : j + 5]) for j in range(len(parts) - 4)}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = {(i, i + 1) for i in range(0, 800, 2) if near(i, i + 1)}
    assert 100 < len(want) < 300
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash.similar, "__defaults__", (16, BANDS, crowd))
    found = simhash.near_duplicates(frame, shingle=5, similarity=0.8, words=8).collect()
    got = {(r["component_id"], r["doc_id"]) for r in found if r["doc_id"] != r["component_id"]}
    assert got <= want
    assert len(want - got) <= 0.01 * len(want)


def test_similar_pairs_meet_in_a_band():
    """The docstring's figures for the default bands of 16 bits."""
    for similarity, least in ((0.8, 0.997), (0.85, 0.9999)):
        differs = np.arccos(2 * similarity / (1 + similarity)) / np.pi
        assert 1 - (1 - (1 - differs) ** 16) ** BANDS >= least


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(500, 100 + i) for i in range(40)] + [(7, 7)]
    found = connected(spark.createDataFrame(path, "u long, v long")).collect()
    got = {r["node"]: r["root"] for r in found}
    assert len(found) == len(got)
    assert {got[i] for i in range(61)} == {0}
    assert {got[100 + i] for i in range(40)} == {100} == {got[500]}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


LINES = [
    "first line of the header\nbody one is here today\n\nshort\nend of it",
    "first line of the header\nbody two is here today\nshort\nend of it\nbody two is here today",
    "a\nb\nc",
    "a\nb\nc",
    "a\nb\nc\nd is a longer line than all of them",
    "a\n\nb\n \nc\nd is a longer line than all of them",
    "short\nend of it\nand something else that is long",
    "", None, "\n\n", " ", "same long line, over and over\n" * 50,
]


@pytest.mark.parametrize("least", [20, 5])
def test_lines_equal_brute_force(spark, docs, least):
    rows = [(r[0], r[1]) for r in ROWS] + [(800 + i, t) for i, t in enumerate(LINES)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = frame.withColumns({"id": F.lit("clash"), "hash": F.lit(1), "at": F.lit(2)})
    found = lines.dedup_lines(frame, least).collect()
    want = twins.kept_lines([(twins.order_id(i), t or "") for i, t in rows], least)
    got = sorted((str(r["doc_id"]), r["kept"], r["n_removed"]) for r in found)
    assert got == sorted((str(i), *w) for (i, _), w in zip(rows, want))
    assert found[0]["id"] == "clash"


def test_short_lines_at_both_ends_of_a_run_go(spark):
    """A repeated run that begins and ends in short lines is deleted whole, also where another
    document has its long line in another context first."""
    long = "x" * 40
    texts = [f"q\n{long}\nother", f"aa\nbb\n{long}\nok\nend", f"zz\naa\nbb\n{long}\nok\nlast"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in lines.dedup_lines(frame).collect()}
    assert got == {0: texts[0], 1: "aa\nbb\nok\nend", 2: "zz\nlast"}


def test_lines_equal_sql(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([r[1] for r in ROWS] + LINES)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(SQL["op10_line_dedup"]).fetchall()
    from shelfcast.llm.queries import QUERIES

    got = [tuple(r) for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_hilbert_keys_are_a_path():
    for count, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * count), axis=-1).reshape(-1, count)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1500, 32)).round(3)
    data[100:400] = data[100]
    rows = [(int(i), v.tolist()) for i, v in enumerate(data)]
    odd = [(5000, None), (5050, [0.0] * 32), (5100, [None] + [1.0] * 31), (5150, [float("nan")] * 32),
           (5200, [float("inf")] * 32), (5250, [1.0]), (None, data[3].tolist()), (5300, [])]
    vectors = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>")
    vectors = vectors.withColumns({"vec": F.lit(1), "cid": F.lit(2), "place": F.lit(3)})
    found = ann.nearest(vectors, F.col("id") % 50 == 0, curves=30, window=0.06).collect()
    single = data.astype(np.float32).astype(np.float64)
    want = twins.nearest(list(range(1500)), single, range(0, 1500, 50), 5)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(want) and {len(v) for v in got.values()} == {5}
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)
    # equal vectors: the smallest ids, none of them the query's own
    assert got[150] == [100, 101, 102, 103, 104] and got[100] == [101, 102, 103, 104, 105]
    few = ann.nearest(vectors.where("vec_id in (50, 51, 52)"), F.col("id") == 50).collect()
    assert [(r["rank"], r["vec_id"]) for r in few] == [(1, r["vec_id"]) if i == 0 else (2, r["vec_id"]) for i, r in enumerate(few)]
    assert len(few) == 2
    assert ann.nearest(vectors.limit(0), F.col("id") == 50).count() == 0


def test_neighbours_recall_with_the_defaults(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 32))
    data = (centres[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 32))).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    want = twins.nearest(list(range(6000)), data, range(0, 6000, 50), 5)
    got = {}
    for r in ann.nearest(vectors, F.col("id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {len(v) for v in got.values()} == {5}
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_neighbour_groups_are_bounded(spark):
    """Groups hold few rows however wide the window, and together each pair within it once."""
    rows = [(c, p, p, [p], [1.0], p % 3 == 0) for c in range(2) for p in range(1000)]
    placed = spark.createDataFrame(
        rows, "curve int, place long, cid long, ids array<long>, vec array<double>, wanted boolean"
    )
    data, asked = ann._dealt(placed, half=150, block=40, chunk=10)
    groups = {}
    for side, (rows, names) in enumerate(((data, ""), (asked, "on_curve in_block in_chunk"))):
        for r in rows.collect():
            key = tuple(r[n] for n in (names or "curve block chunk").split())
            groups.setdefault(key, ([], []))[side].append(r["place"])
    assert max(len(d) for d, _ in groups.values()) <= 40
    assert max(len(a) for _, a in groups.values()) <= 30
    pairs = [(k[0], x, y) for k, (d, a) in groups.items() for x in a for y in d if abs(x - y) <= 150]
    want = 2 * sum(min(999, p + 150) - max(0, p - 150) + 1 for p in range(0, 1000, 3))
    assert len(pairs) == want == len(set(pairs))
