"""Plain-Python twins of the operators for small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

LAST = (1 << 63) - 1

SCHEMA = "doc_id long, text string, lang string, source string, bucket string, n_chars int"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def awkward_texts() -> list[str | None]:
    """NULL, empty, blank, very long and repeated texts, and copies with small changes."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghio", k=rng.randint(1, 9))) for _ in range(300)]

    def prose(n: int) -> str:
        parts = [rng.choice(words) + rng.choice(["", "", "", ".", ",", "!!"]) for _ in range(n)]
        return " ".join(p.capitalize() if rng.random() < 0.2 else p for p in parts)

    base = [prose(rng.randint(1, 120)) for _ in range(25)]
    out: list[str | None] = [None, "", " \n\t ", "a", "1234 ... !!", "\x1c\x1f\x85 é́ ß", None]
    out += base + base[:6] + [base[0] * 400, "la " * 5000, "x" * 20000]
    for _ in range(12):
        a, b = rng.choice(base), rng.choice(base)
        out.append(a[rng.randint(0, 40) :] + "\n" + b + "\n" + a[: rng.randint(0, 300)])
    for _ in range(10):
        text = rng.choice(base).split()
        text[rng.randrange(len(text))] = "changed"
        out.append(" ".join(text))
    return out


def rows_of(texts: list[str | None]) -> list[tuple]:
    """Rows with columns that clash with the operators' own, NULL ids and repeated rows."""
    rows = [(i, t, "en", "clash", "clash", 1) for i, t in enumerate(texts)]
    rows += [(None, texts[8], None, None, None, None), (None, None, None, None, None, None)]
    rows += [rows[9], rows[9], (9, "another text under one id", "de", None, None, 2)]
    return rows


def order_id(doc_id: int | None) -> int:
    return LAST if doc_id is None else doc_id


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n: int, linked) -> list[int]:
    """Root of each position under the links of a predicate on two positions."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def covered(ids: list[int], texts: list[bytes], length: int) -> list[bytes]:
    """One byte per byte of each text: 1 if an earlier document has a string over it."""
    first: dict[bytes, int] = {}
    for i, t in sorted(zip(ids, texts), key=lambda r: r[0]):
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], i)
    out = []
    for i, t in zip(ids, texts):
        marks = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                marks[p : p + length] = b"\1" * length
        out.append(bytes(marks))
    return out


def ngram_scores(rows: list[tuple[int | None, str | None]], mass: float) -> list[tuple]:
    """(held out, tokens, known, training tokens, base score, score) of each row."""
    tokens = [
        [*re.findall(b"[^\x20\x09-\x0d]+", lower(t or "").encode()), None] for _, t in rows
    ]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    words, pairs, starts = Counter(), Counter(), 0
    for own, out in zip(tokens, held):
        if not out:
            words.update(own)
            pairs.update(zip([0, *own], own))
            starts += 1
    total, floor = sum(words.values()), sum(words.values()) + 0.1 * (len(words) + 1)
    found = []
    for own, out in zip(tokens, held):
        base = score = 0.0
        for before, word in zip([0, *own], own):
            alone = (words[word] + 0.1) / floor
            n = pairs[(before, word)]
            context = starts if before == 0 else words[before]
            after = mass * alone / (context + mass)
            if n:
                least = (2 ** (math.floor(8 * math.log2(words[word])) / 8) + 0.1) / floor
                exact = (n + mass * least) / (context + mass)
                after = max(after, 2 ** (-math.ceil(-8 * math.log2(exact)) / 8))
            base += math.log10(alone)
            score += math.log10(after)
        found.append((out, len(own), sum(words[w] > 0 for w in own), total, base, score))
    return found


def ngram_scores_of_three(rows: list[tuple[int | None, str | None]], mass: float) -> list[float]:
    """Score of each row by the model of order three."""
    tokens = [
        [0, *re.findall(b"[^\x20\x09-\x0d]+", lower(t or "").encode()), None] for _, t in rows
    ]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    # of runs of one to three tokens; a start mark is no token, but begins runs
    counts = Counter()
    for own, out in zip(tokens, held):
        for n in (1, 2, 3):
            if not out:
                counts.update(tuple(own[k : k + n]) for k in range(len(own) - n + 1))
    words = {run[0]: n for run, n in counts.items() if len(run) == 1 and run[0] != 0}
    floor = sum(words.values()) + 0.1 * (len(words) + 1)

    def down(p: float) -> float:
        return 2 ** (-math.ceil(-8 * math.log2(p)) / 8)

    def after(run: tuple) -> float:
        if len(run) == 1:
            return (words.get(run[0], 0) + 0.1) / floor
        lower_p = after(run[1:])
        n, context = counts[run], counts[run[:-1]]
        p = mass * lower_p / (context + mass)
        if n and len(run) == 2:
            lower_p = (2 ** (math.floor(8 * math.log2(words[run[1]])) / 8) + 0.1) / floor
        if n:
            least = down(lower_p) if len(run) == 3 else lower_p
            p = max(p, down((n + mass * least) / (context + mass)))
        return p

    return [
        sum(math.log10(after(tuple(own[max(0, k - 2) : k + 1]))) for k in range(1, len(own)))
        for own in tokens
    ]


def window_hits(text: str | None, items: list[tuple[str, str]], window: int = 10) -> tuple:
    """(words, words hit, number of items, digest of the items)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = word.findall(lower(text or ""))
    hit, found = [False] * len(own), set()
    for item, body in items:
        parts = word.findall(lower(body or ""))
        for first in range(max(1, len(parts) - window + 1) if parts else 0):
            part = parts[first : first + window]
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hit[at : at + len(part)] = [True] * len(part)
                    found.add(item)
    return len(own), sum(hit), len(found), sha(",".join(sorted(found)))


def kept_lines(rows: list[tuple[int, str]], least: int) -> list[tuple[str, int]]:
    """(text without later repeated runs, number of lines deleted) of each row: every run of
    `least` characters or more that also stands earlier goes, whatever its length."""
    runs, first = [], {}
    places = [(i, xx(t), t) for i, t in rows]
    for place in set(places):
        parts = place[2].split("\n")
        full = [k for k, line in enumerate(parts) if line.strip(" ")]
        total = sum(len(parts[k]) for k in full)
        for a in range(len(full)):
            size = 0
            for b in range(a, len(full)):
                size += len(parts[full[b]])
                if size >= least or (total < least and a == 0 and b == len(full) - 1):
                    key = tuple(parts[k] for k in full[a : b + 1])
                    runs.append((place, full[a], full[a : b + 1], key))
    for place, at, _, key in runs:
        here = (*place[:2], at)
        first[key] = min(first.get(key, here), here)
    gone = {p: set() for p in places}
    for place, at, run, key in runs:
        if (*place[:2], at) > first[key]:
            gone[place].update(run)
    return [
        ("\n".join(x for k, x in enumerate(p[2].split("\n")) if k not in gone[p]), len(gone[p]))
        for p in places
    ]


def xx(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def nearest(ids, vectors, queries, k: int) -> dict[int, list[int]]:
    data = np.array(vectors, dtype=np.float64)
    length = np.linalg.norm(data, axis=1)
    out = {}
    for q in queries:
        score = data @ data[q] / length / length[q]
        order = sorted((-score[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[q])
        out[ids[q]] = [i for _, i in order[:k]]
    return out
