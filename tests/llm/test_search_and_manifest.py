"""Operators 11 to 13 against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import fptree, merkle, pstable
from tests.llm import twins

ROWS = twins.rows_of(twins.awkward_texts())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, twins.SCHEMA).repartition(3)


# ------------------------------------------------------------------ operator 11


def _vectors() -> list[tuple]:
    """Clusters, copies, scaled copies, and vectors that take no part."""
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 7))):
                rows.append((label, (centre + rng.normal(size=16) * rng.choice([0.02, 0.06, 0.1])).tolist()))
    rows += [rows[3]] * 9 + [(rows[5][0], [2 * x for x in rows[5][1]])] * 2
    rows += [(1, rows[0][1]), (0, rows[0][1][:8]), (0, rows[1][1][:8])]
    rows += [(0, None), (0, []), (0, [0.0] * 16), (0, [float("nan")] * 16), (0, [float("inf")] + [1.0] * 15)]
    rows += [(1, [None] + [1.0] * 15), (1, [1e200] * 16), (1, [1e-200] * 16)]
    order = rng.permutation(len(rows)).tolist()
    out = [(i, *rows[j]) for i, j in enumerate(order)]
    # an id that repeats, and rows without one
    return out + [(7, *rows[3]), (None, *rows[3]), (None, 5, [1.0] * 16), (None, 5, None)]


def _linked(rows: list[tuple], cosine: float) -> list[tuple]:
    def unit(label, vector):
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            return None
        v = np.array(vector) / np.abs(vector).max()
        return v / math.sqrt(v @ v)

    units = [unit(label, vector) for _, label, vector in rows]

    def near(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b >= cosine

    roots = twins.groups(len(rows), near)
    least: dict[int, int] = {}
    for row, root in zip(rows, roots):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    links = [sum(bool(near(i, j)) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return [(r[0], n, least.get(root), r[0] == least.get(root)) for r, n, root in zip(rows, links, roots)]


@pytest.mark.parametrize("crowd", [pstable.CROWD, 3])
@pytest.mark.parametrize("kind", ["double", "float"])
def test_links_equal_brute_force(spark, crowd, kind):
    rows = _vectors()
    if kind == "float":
        rows = [r for r in rows if not r[2] or max(abs(x or 0) for x in r[2]) < 1e30]
        single = np.float32
        rows = [(i, y, v and [None if x is None else float(single(x)) for x in v]) for i, y, v in rows]
    schema = f"vec_id long, label int, embedding array<{kind}>, node int, keys string"
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], schema).repartition(3)
    found = pstable.near_duplicates(df, crowd=crowd)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = _linked(rows, 0.98)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert max(w[1] for w in want) >= 10


def test_agreement_and_tables():
    rng = np.random.default_rng(1)
    n = 200_000
    for distance in (0.2, 1.0, math.sqrt(2)):
        a = rng.normal(size=n) * distance
        b = rng.uniform(0, pstable.WIDTH, n)
        same = np.floor(b / pstable.WIDTH) == np.floor((a + b) / pstable.WIDTH)
        assert same.mean() == pytest.approx(pstable.agreement(distance), abs=0.005)
    assert pstable.agreement(0.0) == 1.0
    for size in (1, 1000, 10**9):
        projections, tables = pstable.table_sizes(size, 0.98)
        near, far = pstable.agreement(0.2), pstable.agreement(math.sqrt(2))
        assert (1 - near**projections) ** tables <= pstable.MISS * 1.0001
        assert size * far**projections <= pstable.STRANGERS * 2


def test_recall_on_pairs_at_the_threshold(spark):
    """600 pairs with a cosine just above the threshold; all of them come together."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(600):
        a, b = rng.normal(size=(2, 32))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        angle = math.acos(0.9805)
        rows += [(2 * i, 1, a.tolist()), (2 * i + 1, 1, (math.cos(angle) * a + math.sin(angle) * b).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = pstable.near_duplicates(df).filter("vec_id % 2 = 1").collect()
    assert sum(r["component_id"] == r["vec_id"] - 1 and r["n_links"] == 1 for r in found) >= 597


# ------------------------------------------------------------------ operator 12


def _terms(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", twins.lower(text)) if text else []


def _ranked(docs: list[tuple], items: list[tuple], best: int) -> list[tuple]:
    held = [(d, Counter(t), len(t)) for d, t in ((d, _terms(text)) for d, text in docs) if t]
    n, total = len(held), sum(s for _, _, s in held)
    frequency = Counter(t for _, c, _ in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t, df in frequency.items()}
    out = []
    for item, text in items:
        asked, scores = Counter(_terms(text)), []
        for d, counts, size in held:
            m = 100 - 75 + (75 * size * n) // total
            score = sum(
                times * weight[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, times in asked.items()
                if t in counts
            )
            if score > 0:
                scores.append((-score, twins.order_id(d), d))
        scores.sort(key=lambda s: s[:2])
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:best])]
    return out


def _items() -> list[tuple]:
    texts = [t for t in twins.awkward_texts() if t]
    items = [(i, t[: 40 + 7 * i]) for i, t in enumerate(texts[5:30])]
    return items + [(100, None), (101, ""), (102, "..."), (103, "nowhere"), (3, "one id twice"), (None, texts[9]), (104, texts[9])]


@pytest.mark.parametrize(("shard", "leaf", "part", "block"), [(20_000, 256, 4_000_000, 8_000_000), (9, 2, 200, 300)])
def test_ranks_equal_brute_force(spark, docs, monkeypatch, shard, leaf, part, block):
    for name, value in (("SHARD", shard), ("LEAF", leaf), ("PART", part)):
        monkeypatch.setattr(fptree, name, value)
    items = spark.createDataFrame([(*i, 1) for i in _items()], "item_id long, text string, key int")
    found = fptree.rank_documents(docs, items, best=4, block=block).collect()
    want = _ranked([(r[0], r[1]) for r in ROWS], _items(), 4)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_search_visits_less_than_everything(monkeypatch):
    """Bounds hold and cut: the best documents are found without scoring all of them."""
    monkeypatch.setattr(fptree, "LEAF", 8)
    rng = np.random.default_rng(3)
    words = [f"w{i}".encode() for i in range(60)]
    common_ = [b" ".join(words[int(i)] for i in rng.integers(0, 60, 40)) for _ in range(600)]
    rare = [b" ".join([words[int(i)] for i in rng.integers(0, 60, 10)] + [b"rare"] * 5) for _ in range(5)]
    blobs, items = common_ + rare, [b"rare w1"]
    known = fptree.vocabulary(items)
    lengths, terms, tfs = fptree.term_counts(blobs, known)
    frequency = np.bincount(np.concatenate(terms), minlength=len(known))
    index = fptree.ItemIndex.make(known, items, frequency, len(blobs))
    m = np.array([25 + 75 * int(x) * len(blobs) // int(lengths.sum()) for x in lengths])
    paths, own = [], []
    for t, f in zip(terms, tfs):
        order = np.argsort(index.number[t])
        paths.append(index.number[t][order])
        own.append(f[order])
    search, scored = fptree.Search(index, 5), []
    plain = search.score
    monkeypatch.setattr(search, "score", lambda tree, node, active: (scored.append(node.high - node.low), plain(tree, node, active)))
    search.visit(fptree.Tree(paths, own, m, np.arange(len(blobs))))
    assert set(search.found[0][1].tolist()) == set(range(600, 605))
    assert sum(scored) < 300


def test_scores_beyond_doubles_are_exact():
    """Counts so large that doubles would round: the integer way is taken."""
    items = [b"a " * 400_000 + b"b"]
    words = fptree.vocabulary(items)
    index = fptree.ItemIndex.make(words, items, np.array([1, 1]), 10**12)
    assert not index.exact
    weight = math.floor(1000 * math.log((2 * 10**12 + 2) / 3))
    tf, m = np.array([3, 7]), np.array([26, 26])
    got = index.scores(np.zeros(2, dtype=np.int64), 1, np.arange(2), tf, m, np.arange(1))[0, 0]
    parts = [weight * ((10**9 * t) // (1000 * t + 8 * 26)) for t in (3, 7)]
    times = {index.number[np.searchsorted(words, fptree.vocabulary([w])[0])]: n for w, n in ((b"a", 400_000), (b"b", 1))}
    assert got == sum(parts[int(k)] * n for k, n in times.items())


# ------------------------------------------------------------------ operator 13


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(*values) -> str:
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(leaves: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and, for each leaf, what stands left and right of its way on each level."""
    ways: list[list[tuple[str, str]]] = [[] for _ in leaves]
    at, level = list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, pos in enumerate(at):
            first = pos - pos % fanout
            run = level[first : first + fanout]
            ways[i].append(("".join(run[: pos - first]), "".join(run[pos - first + 1 :])))
        level = [_sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [pos // fanout for pos in at]
    return level[0], ways


def _manifest(rows: list[tuple], fanout: int) -> list[tuple]:
    groups: dict = {}
    for doc_id, text, lang, source, _, n_chars in rows:
        groups.setdefault(lang, []).append((doc_id, _leaf(doc_id, source, lang, n_chars, text)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {}
    for name in order:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        done[name] = (own, *_tree([leaf for _, leaf in own], fanout))
    root, upper = _tree([done[name][1] for name in order], fanout)
    out = []
    for name, above in zip(order, upper):
        own, subroot, ways = done[name]
        for (doc_id, leaf), way in zip(own, ways):
            out.append((doc_id, leaf, subroot, root, _sha("".join(a + b for a, b in way + above))))
    return out


@pytest.mark.parametrize("fanout", [2, 3])
@pytest.mark.parametrize("kind", ["all", "one group", "one row"])
def test_manifest_equals_brute_force(spark, fanout, kind):
    rows = {"all": ROWS, "one group": [r for r in ROWS if r[2] == "en"], "one row": ROWS[8:9]}[kind]
    if kind == "all":
        rows = rows + [(700 + i, "z", "zß", None, None, i) for i in range(5)] + [(900, None, "", "s", None, 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], twins.SCHEMA + ", path int").repartition(4)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [*fields[:3], F.col("n_chars") + 1, fields[4]]
    found = merkle.manifest(
        df, F.col("lang"), F.col("doc_id"), merkle.row_digest(*fields), fanout, shown=merkle.row_digest(*more)
    )
    got = found.select(
        "id",
        *[merkle.hex_text(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.proof_text("path").cast("binary"), 256),
        merkle.fold("leaf", "path") == F.col("root"),
        merkle.fold("shown", "path") == F.col("root"),
    ).collect()
    want = _manifest(rows, fanout)
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(map(str, want))
    assert all(r[5] for r in got)
    # what was changed is found out, unless it has nothing to change
    unchanged = [r[0] for r in got if r[6]]
    assert sorted(map(str, unchanged)) == sorted(str(r[0]) for r in rows if r[5] is None)


def test_order_and_partitions_do_not_matter(spark, docs):
    def root(df):
        leaf = merkle.row_digest(F.col("doc_id"), F.col("text"))
        return {bytes(r["root"]) for r in merkle.manifest(df, F.col("lang"), F.col("doc_id"), leaf).collect()}

    assert root(docs) == root(docs.repartition(7).orderBy(F.rand(3)))
    assert root(docs) != root(docs.withColumn("text", F.concat("text", F.lit("!"))))
    assert root(docs.limit(0)) == set()
