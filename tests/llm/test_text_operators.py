"""Operators that judge each text by itself: BPE, language, decontamination, secrets."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from shelfcast.llm import bpe, common, decontaminate, langid, quality, secrets, simhash
from shelfcast.llm.queries import tokenizer_path
from tests.llm import twins

TEXTS = twins.awkward_texts()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(twins.rows_of(TEXTS), twins.SCHEMA)


def test_bpe_equals_the_library(spark, docs):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    rng = random.Random(2)
    more = ["".join(rng.choices("abcdeghin'<|>.! \n\tÉßΣ0", k=200)) for _ in range(60)]
    more += ["a<|endoftext|>b  <|startoftext|>", "ΑΣ ΣΑΣ İ don't we'LL 12345 ½ Ⅻ \x1c\x85　", "日本 \U0001f600"]
    more += ["=" * 999, "\0<|endoftext|>\0", "l" * 501, "abcabc" * 80]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    model = bpe.BpeModel.from_file(tokenizer_path())
    both = docs.select("doc_id", "text").union(extra)
    found = bpe.encode_documents(both, model).withColumn("again", bpe.decode_ids(spark, model, "bpe.ids"))
    found = found.withColumn("digest", bpe.encode_digest(spark, model, "text"))
    for row in found.collect():
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(want, skip_special_tokens=False)
        assert list(row["bpe"]["ids"]) == want
        assert row["bpe"]["decoded"] == row["again"] == decoded
        digest = (len(want), twins.sha(" ".join(map(str, want))), twins.sha(decoded))
        assert tuple(row["digest"]) == digest


def test_bpe_forgets_words_and_cuts_chunks(monkeypatch):
    encoder = bpe.Encoder(bpe.BpeModel.from_file(tokenizer_path()))
    want = list(encoder.encoded(TEXTS))
    monkeypatch.setattr(bpe, "KEPT_STRETCHES", 10)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 300)
    encoder = bpe.Encoder(bpe.BpeModel.from_file(tokenizer_path()))
    assert list(encoder.encoded(TEXTS)) == want


def test_bpe_lower_rank_opened_by_a_merge():
    """A rule that opens a pair of a lower rank is applied one pair at a time."""
    rules = [("abc", "ab"), ("b", "c"), ("a", "bc"), ("a", "b"), ("ab", "c")]
    symbols = sorted({x for pair in rules for x in pair} | {a + b for a, b in rules})
    vocab = {s: i for i, s in enumerate(symbols)}

    def plain(word: list[str]) -> list[str]:
        while True:
            ranked = [(rules.index(p), i) for i, p in enumerate(zip(word, word[1:])) if p in rules]
            if not ranked:
                return word
            i = min(ranked)[1]
            word = word[:i] + [word[i] + word[i + 1]] + word[i + 2 :]

    import numpy as np

    table = bpe.PairTable([(vocab[a], vocab[b]) for a, b in rules], [vocab[a + b] for a, b in rules])
    assert table.early.any()
    rng = random.Random(1)
    words = [rng.choices("abc", k=rng.randint(1, 14)) for _ in range(200)]
    flat = np.array([vocab[c] for w in words for c in w])
    index = bpe.PairIndex(table, flat, np.array([len(w) for w in words]))
    index.merge_all()
    assert [[symbols[i] for i in w] for w in index.words()] == [plain(list(w)) for w in words]


def test_language_on_held_out_prose(spark):
    rng = random.Random(3)
    sounds = {"en": ["the", "ing", "ou", "er"], "de": ["sch", "ung", "ü", "ein"], "fr": ["é", "eaux", "qu", "è"]}
    rows = []
    for i in range(240):
        lang = rng.choice(list(sounds))
        text = " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang))
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 34 !!", "de"), (903, "the ing", None), (None, "éeaux", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.where("doc_id % 3 != 1"), train_docs=60)
    found = docs.select("doc_id", "text", "lang", langid.predict(spark, model, "text").alias("p")).collect()
    for row in found:
        unread = row["text"] is None or not regex.search(r"\p{L}", row["text"])
        assert (row["p"]["lang_pred"] == "und") == unread
        assert 0 <= row["p"]["score"] <= 1
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] % 3 == 1]
    assert sum(r["lang"] == r["p"]["lang_pred"] for r in held) >= 0.98 * len(held)
    nothing = langid.train(docs.limit(0))
    assert {r["p"]["lang_pred"] for r in docs.select(langid.predict(spark, nothing, "text").alias("p")).collect()} == {"und"}


def test_code_lengths_are_exact():
    """The tables give the code lengths that a plain walk along the context tree gives."""
    import numpy as np
    import pandas as pd

    rng = random.Random(6)
    texts = {"a": "".join(rng.choices("abcd e", k=400)), "b": "".join(rng.choices("abef g", k=300))}
    frames, counts = [], {}
    for lang, text in texts.items():
        data = b"    " + text.encode() + b"    "
        grams, n = np.unique(langid.four_bytes(np.frombuffer(data, dtype=np.uint8)), return_counts=True)
        frames.append(pd.DataFrame({"lang": lang, "gram": grams, "n": n}))
        for gram, k in zip(grams.tolist(), n.tolist()):
            for order in range(4):
                context, byte = gram >> 8 & (1 << 8 * order) - 1, gram & 255
                own = counts.setdefault((lang, order, context), {})
                own[byte] = own.get(byte, 0) + k
    model = langid.fit(pd.concat(frames))
    seen = {b for own in counts.values() for b in own}
    assert len(seen) < langid.SYMBOLS

    def cost(lang, data, i):
        total = 0.0
        for order in (3, 2, 1, 0):
            own = counts.get((lang, order, int.from_bytes(data[i - order : i], "big")), {})
            size, kinds = sum(own.values()), len(own)
            if data[i] in own:
                return total - np.log2(own[data[i]] / (size + kinds))
            if kinds:
                total -= np.log2(kinds / (size + kinds))
        return total + np.log2(langid.SYMBOLS)

    samples = ["abe fg", "dddd", "", "ag ag abcd ef" * 9]
    bits = langid.Scorer(model).bits([s.encode() for s in samples])
    for s, row in zip(samples, bits):
        data = b"   " + s.encode()
        for lang, got in zip(model.langs, row):
            assert got == pytest.approx(sum(cost(lang, data, i) for i in range(3, len(data))), rel=1e-5)


def test_code_lengths_are_exact_beyond_64_bytes():
    import numpy as np
    import pandas as pd

    rng = random.Random(16)
    letters = {
        "el": [chr(c) for c in range(0x3B1, 0x3CA)],
        "ru": [chr(c) for c in range(0x430, 0x450)],
        "ja": [chr(c) for c in range(0x4E00, 0x4F00)],
    }
    texts = {lang: "".join(rng.choices([*own, *"aeinrst "], k=4000)) for lang, own in letters.items()}
    frames, counts = [], {}
    for lang, text in texts.items():
        data = b"    " + text.encode() + b"    "
        grams, n = np.unique(langid.four_bytes(np.frombuffer(data, dtype=np.uint8)), return_counts=True)
        frames.append(pd.DataFrame({"lang": lang, "gram": grams, "n": n}))
        for gram, k in zip(grams.tolist(), n.tolist()):
            for order in range(4):
                own = counts.setdefault((lang, order, gram >> 8 & (1 << 8 * order) - 1), {})
                own[gram & 255] = own.get(gram & 255, 0) + k
    assert len({b for text in texts.values() for b in text.encode()}) > 64
    model = langid.fit(pd.concat(frames))

    def cost(lang, data, i):
        total = 0.0
        for order in (3, 2, 1, 0):
            own = counts.get((lang, order, int.from_bytes(data[i - order : i], "big")), {})
            size, kinds = sum(own.values()), len(own)
            if data[i] in own:
                return total - np.log2(own[data[i]] / (size + kinds))
            if kinds:
                total -= np.log2(kinds / (size + kinds))
        return total + 8

    samples = ["αβγ ta", "где σ 一丁", "\x01\x02é", "", "一七万 丈三" * 9]
    for s, row in zip(samples, langid.Scorer(model).bits([s.encode() for s in samples])):
        data = b"   " + s.encode()
        for lang, got in zip(model.langs, row):
            assert got == pytest.approx(sum(cost(lang, data, i) for i in range(3, len(data))), rel=1e-5)


ITEMS = [
    ("7", "One two three four five six seven eight nine ten eleven twelve"),
    ("10", "short item"),
    ("2", "short item"),
    ("3", None),
    ("4", "?! ..."),
    ("5", "é two three four five six seven eight nine ten, Üben 7"),
    (None, "unnamed words here"),
]


def test_decontamination_equals_brute_force(spark, docs):
    texts = [
        "zero one TWO three four. five six seven eight nine ten eleven twelve thirteen",
        "a short ITEM, and one two three four five six seven eight nine",
        "unnamed words here twice: unnamed words here",
        "é two three four five six seven eight nine ten üben 7",
        "short item short item short short item",
        "one two three four five six seven eight nine ten " * 300,
    ]
    extra = spark.createDataFrame([(500 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    both = docs.select("doc_id", "text").union(extra)
    named = [(i, t) for i, t in ITEMS if i is not None]
    for block in (decontaminate.BLOCK, 40):
        benchmark = decontaminate.Benchmark(items, block=block)
        assert (len(benchmark.shared) > 1) == (block == 40)
        found = both.select(
            "text",
            decontaminate.hit_digest(benchmark, "text").alias("d"),
            decontaminate.hit_spans(benchmark, "text").alias("s"),
        ).collect()
        for row in found:
            want = twins.window_hits(row["text"], named)
            every = twins.window_hits(row["text"], [("u", t) if i is None else (i, t) for i, t in ITEMS])
            assert tuple(row["d"]) == (want[0], every[1], *want[2:])
            spans = [tuple(map(int, re.findall(r"\d+", s))) for s in row["s"]["spans"]]
            assert sum(b - a for a, b in spans) == every[1]
            assert len(row["s"]["items"]) == want[2]
            if not spans:
                assert row["s"]["kept"] == (row["text"] or "")
    nothing = decontaminate.Benchmark(items.limit(0))
    assert both.where(decontaminate.contaminated(spark, nothing, F.col("text"))).count() == 0


def test_texts_longer_than_a_part(monkeypatch):
    """Operators 5, 6 and 8 give the same for small parts, which long texts exceed."""
    long = ["one two three four five six seven eight nine ten short item é " * 200, "αβγ dog " * 500]
    blobs = common.text_bytes([*TEXTS, *long, None, "", "x"])
    prose = {"a": "the dog barks at the cat ", "b": "der Hund bellt die Katze an "}
    frames = []
    for lang, text in prose.items():
        data = np.frombuffer(b"    " + text.encode() * 5, dtype=np.uint8)
        gram, n = np.unique(langid.four_bytes(data), return_counts=True)
        frames.append(pd.DataFrame({"lang": lang, "gram": gram, "n": n}))
    scorer = langid.Scorer(langid.fit(pd.concat(frames)))
    phrases = decontaminate.Phrases.from_items(ITEMS, decontaminate.WINDOW)

    def hits(limit: int) -> list[tuple]:
        out = []
        for first, last in common.slices([len(b) for b in blobs], limit):
            found = decontaminate.search_shard(blobs[first:last], iter([(0, phrases)]))
            out += [row[:3] for row in decontaminate.text_hits(found, phrases.items)]
        return out

    def all_of(limit: int):
        prints = [simhash.text_signature(b, 4, 1).hex() for b in blobs]
        return prints, scorer.bits(blobs), hits(limit)

    whole = all_of(decontaminate.SHARD)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    monkeypatch.setattr(langid, "CHUNK", 60)
    parts = all_of(60)
    assert parts[0] == whole[0] == ["%016x" % twins.fingerprint(b.decode()) for b in blobs]
    assert np.allclose(parts[1], whole[1])
    assert parts[2] == whole[2]
    assert any(hit for _, hit, _ in whole[2])


def _peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_worker_is_that_of_a_part():
    """Scoring and encoding hold a few megabytes beside the texts, however many there are."""
    rng = np.random.default_rng(4)
    letters = rng.integers(97, 123, (300_000, 10)).astype(np.uint8)
    letters[:, -1] = 32
    texts = [row.tobytes().decode() for row in letters.reshape(1000, -1)]
    gram, n = np.unique(langid.four_bytes(letters.ravel()[:60_000]), return_counts=True)
    counts = [pd.DataFrame({"lang": lang, "gram": gram[i::4], "n": n[i::4]}) for i, lang in enumerate("abcd")]
    scorer = langid.Scorer(langid.fit(pd.concat(counts)))
    blobs = [t.encode() for t in texts]
    assert _peak_mb(lambda: scorer.bits(blobs)) < 40
    encoder = bpe.Encoder(bpe.BpeModel.from_file(tokenizer_path()))
    assert _peak_mb(lambda: sum(n for _, n, _ in encoder.encoded(texts))) < 200


def test_text_parts():
    texts = ["abc", None, "", "é" * 3, "x" * 20, None, "yy", "z"]
    parts = list(common.text_parts(pa.array(texts), 9))
    assert parts == [["abc", None, "", "é" * 3], ["x" * 20], [None, "yy", "z"]]
    assert list(common.text_parts(pa.array(texts)[5:6], 9)) == [[None]]
    assert list(common.text_parts(pa.array([], pa.string()), 9)) == []
    kind = "n long, words array<string>"
    rows = [[(1, ["a", "b"]), (2, [])], [], [(None, None)]]
    assert common.struct_array(kind, rows).to_pylist() == [{"n": n, "words": w} for part in rows for n, w in part]
    assert len(common.struct_array(kind, [])) == 0


SECRET_TEXTS = [
    "password = 'hunter22xyz' Token:abcdefgh api_KEY=short secret: \"A.b/c+d=e_f-g\"",
    "passwordpassword=longenough1 tokentoken = tokentoken",
    "AKIAABCDEFGHIJKL AKIAABC AKIAXAKIAABCDEFGHIJ",
    "é" * 5 + "deadbeef" * 4 + "g" + "0" * 31 + " " + "f" * 64,
    "ſecret=abcdefghij toKen=abcdefghij",
    "key Zx9Kq2Lw8Vb4Nm7Tp3Rs6Yd1Hf5Gj0C and internationalisation of counterrevolutionaries",
]


def test_secrets_keep_base_spans(spark, docs):
    extra = spark.createDataFrame([(700 + i, t) for i, t in enumerate(SECRET_TEXTS)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    # the token to be found is not among the ordinary ones that were learned
    model = secrets.train(both.where("doc_id IS NULL OR doc_id <> 705"))
    found = both.select("text", secrets.secret_digest(spark, model, "text").alias("d")).collect()
    low = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for row in found:
        text = row["text"] or ""
        spans = [("assign", *m.span()) for m in re.finditer(low, text, re.A) if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        counts = [sum(s[0] == kind for s in spans) for kind in ("assign", "access", "hex")]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        joined = ["%s:%d:%d" % s for s in spans]
        assert list(row["d"])[:3] == counts
        assert row["d"]["base_sha256"] == twins.sha(",".join(joined))
        every = row["d"]["spans"].split(",") if row["d"]["spans"] else []
        assert [s for s in every if not s.startswith("markov")] == joined
    assert "markov" in [r for r in found if r["text"] == SECRET_TEXTS[5]][0]["d"]["spans"]
    assert secrets.train(both.limit(0)).score("abc") == pytest.approx(0)
    listed = both.select(secrets.secret_spans(spark, model, "text").alias("s")).collect()
    assert [len(r["s"]["found"]) for r in listed] == [r["s"]["n_found"] for r in listed]


def test_markov_spans_equal_brute_force():
    """Scores are mean log-likelihood ratios of two smoothed models, in a long text as well."""
    rng = random.Random(4)
    chars = secrets.ALPHABET
    strings = ["".join(rng.choices(chars, k=24)) for _ in range(160)]
    plain = [f"{a}_{b}/section-{n}_chapter" for a in ("archive", "history") for b in ("model", "table") for n in range(9)]
    text = " ".join([f"token={x}" for x in strings[:100]] + plain)
    steps: Counter = Counter()
    for label, token in secrets.labelled_tokens(text):
        for before, c in zip(["", *token], token):
            if c in chars:
                steps[label, before if before in chars else "", c] += 1
    place = {"": 0} | {c: i + 1 for i, c in enumerate(chars)}
    model = secrets.MarkovPair.from_counts([(k, place[a], place[b], n) for (k, a, b), n in steps.items()])
    ordinary = Counter()
    for (label, _, c), n in steps.items():
        ordinary[c] += n * (label == 0)
    floor = sum(ordinary.values()) + 0.5 * len(chars)
    prior = {c: (5 * (ordinary[c] + 0.5) / floor, 1) for c in chars}

    def ratio(token: str) -> float:
        total = 0.0
        for before, c in zip(["", *token], token):
            logs = [
                math.log((steps[k, before, c] + prior[c][k]) / sum(steps[k, before, x] + prior[x][k] for x in chars))
                for k in (0, 1)
            ]
            total += logs[1] - logs[0]
        return total / len(token)

    tokens = strings[100:] + plain
    rng.shuffle(tokens)
    text, want = "", []
    for token in tokens:
        text += "é word "
        judged = any(c.isdigit() for c in token) and any(c.isalpha() for c in token)
        score = ratio(token)
        assert model.score(token) == pytest.approx(score)
        if judged and score >= secrets.MARGIN:
            want.append(("markov", len(text), len(text) + 24))
        text += token
    found = [s for s in secrets.find_spans(text, model, secrets.MARGIN)[1] if s[0] == "markov"]
    assert found == want
    assert len(found) >= 50 and not any(text[a:b] in plain for _, a, b in found)


def test_quality_on_held_out_documents(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(600)]
    rows, labels = [], []
    for i in range(700):
        good, toxic = rng.random() < 0.7, rng.random() < 0.2
        text = rng.choices(words, k=rng.randint(20, 150))
        if not good:
            text = [w.upper() + "!!" for w in text]
        if toxic:
            text[::9] = rng.choices(["grim", "vile"], k=len(text[::9]))
        rows.append((i, " ".join(text), f"host{i % 7 if i % 3 else 0}", "a" if i % 2 else None))
        labels.append((i, int(good), int(toxic)))
    rows += [(None, None, None, None), (900, "", "alone", "x"), (901, None, "host0", "a"), (0, *rows[0][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, known.where("doc_id % 2 = 0"), least_docs=4)
    found = quality.score_documents(docs, model).collect()
    assert len(found) == len(rows)
    assert all(0 < r["quality_score"] < 1 and 0 < r["toxic_score"] < 1 for r in found)
    truth = {i: (q, t) for i, q, t in labels}
    held = [r for r in found if r["doc_id"] in truth and r["doc_id"] % 2]
    for k, name in enumerate(("quality_score", "toxic_score")):
        assert sum((r[name] >= 0.5) == truth[r["doc_id"]][k] for r in held) >= 0.97 * len(held)
    # no evidence: the rate of the path, shrunk to the global one where the site is sparse
    alone = [r for r in found if r["doc_id"] == 900][0]
    assert alone["quality_score"] == pytest.approx(model.rates[0], abs=0.02)


def test_quality_rates_are_shrunk(spark):
    """Sites against the plain formulas, with evidence that is nothing but the rates."""
    rows = [(i, None, "big" if i < 400 else "small", "p") for i in range(403)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    model = quality.Evidence({}, quality.np.zeros((40, 1)), [0.0], [0.3])
    found = quality.score_documents(docs, model, ("quality",), strength=10.0).collect()
    assert {round(r["quality_score"], 9) for r in found} == {0.3}


def _site_rows():
    """Documents of hosts and paths that differ, with evidence between -2 and 2."""
    rng = random.Random(21)
    rows = []
    for host in range(6):
        base = rng.uniform(-0.8, 0.8)
        for path in range(rng.randint(1, 4)):
            level = base + rng.uniform(-0.5, 0.5)
            for _ in range(rng.randint(1, 30)):
                rows.append((f"h{host}" if host else None, f"p{path}" if path else None, level + rng.uniform(-1.5, 1.5)))
    return rows + [("alone", "x", 1.5)]


def test_quality_equals_brute_force(spark):
    """Strengths by moments and rates without the document itself, against plain numpy."""
    np = quality.np
    rows, rate = _site_rows(), 0.3
    # one word per document, whose weight is the evidence
    words = {f"w{i}x": 40 + i for i in range(len(rows))}
    weights = np.zeros((40 + len(rows), 1))
    weights[40:, 0] = [e for _, _, e in rows]
    model = quality.Evidence(words, weights, [0.0], [rate])
    frame = spark.createDataFrame([(i, f"w{i}x", h, p) for i, (h, p, _) in enumerate(rows)], "doc_id long, text string, source string, lang string")
    found = {r["doc_id"]: r["quality_score"] for r in quality.score_documents(frame.repartition(3), model, ("quality",)).collect()}

    def logit(x):
        return math.log(x / (1 - x))

    own = np.array([1 / (1 + math.exp(-e - logit(rate))) for _, _, e in rows])
    hosts, paths = {}, {}
    for i, (h, p, _) in enumerate(rows):
        hosts.setdefault(h, []).append(i)
        paths.setdefault((h, p), []).append(i)
    n, n_hosts, n_paths = len(rows), len(hosts), len(paths)
    inside = sum(((own[g] - own[g].mean()) ** 2).sum() for g in paths.values()) / (n - n_paths)
    host_ms = sum(len(g) * (own[g].mean() - own.mean()) ** 2 for g in hosts.values()) / (n_hosts - 1)
    path_ms = sum(len(g) * (own[g].mean() - own[hosts[k[0]]].mean()) ** 2 for k, g in paths.items()) / (n_paths - n_hosts)
    host_size = (n - sum(len(g) ** 2 for g in hosts.values()) / n) / (n_hosts - 1)
    path_size = (n - sum(len(g) ** 2 / len(hosts[k[0]]) for k, g in paths.items())) / (n_paths - n_hosts)
    of_host, of_path = (
        min(max(inside / ((ms - inside) / size), 1.0), 1e6) if ms > inside else 1e6
        for ms, size in ((host_ms, host_size), (path_ms, path_size))
    )
    assert 1 < of_host < 100
    for i, (h, p, e) in enumerate(rows):
        prior = (own[hosts[h]].sum() - own[i] + of_host * rate) / (len(hosts[h]) - 1 + of_host)
        prior = (own[paths[h, p]].sum() - own[i] + of_path * prior) / (len(paths[h, p]) - 1 + of_path)
        assert found[i] == pytest.approx(1 / (1 + math.exp(-e - logit(prior))), abs=1e-9)


def test_sites_improve_on_the_classifier(spark):
    """Where hosts differ, their rates lower the log loss of weak evidence."""
    rng = random.Random(5)
    rows, truth, weights = [], [], []
    for i in range(1500):
        host = i % 10
        good = rng.random() < (0.9 if host < 5 else 0.2)
        truth.append(good)
        weights.append((1 if good else -1) * 0.5 + rng.gauss(0, 0.7))
        rows.append((i, f"w{i}x", f"h{host}", "p"))
    table = quality.np.zeros((40 + len(rows), 1))
    table[40:, 0] = weights
    model = quality.Evidence({f"w{i}x": 40 + i for i in range(len(rows))}, table, [0.0], [0.55])
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")

    def loss(strength):
        scores = quality.score_documents(frame, model, ("quality",), strength=strength).collect()
        return sum(-math.log(r[3] if truth[r["doc_id"]] else 1 - r[3]) for r in scores) / len(rows)

    assert loss(None) < 0.9 * loss(1e9)


def test_quality_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert model.rates == [0.5, 0.5]
    found = quality.score_documents(docs, model).collect()
    assert len(found) == docs.count()
    assert {(r["quality_score"], r["toxic_score"]) for r in found} == {(0.5, 0.5)}
