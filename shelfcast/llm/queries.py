"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    ann,
    bpe,
    decontaminate,
    fptree,
    langid,
    lines,
    merkle,
    ngram,
    pstable,
    quality,
    secrets,
    simhash,
    substrings,
)
from shelfcast.llm.common import doc_remainder, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_register
def op1_hilbert_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, F.col("id") % 50 == 0)


@_register
def op2_ngram_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = ngram.score_documents(docs, doc_remainder("doc_id", 10) != 0, order=3)
    return found.select(
        "doc_id",
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@_register
def op3_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_register
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = quality.train(docs, read_table(spark, folder, "labels"))
    found = quality.score_documents(docs, model)
    keep = (F.col("quality_score") >= 0.5) & (F.col("toxic_score") < 0.5)
    return found.select("doc_id", "quality_score", "toxic_score", keep.alias("keep"))


@_register
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    print_hex = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", print_hex, "component_id")


@_register
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = doc_remainder("doc_id", 3) == 1
    model = langid.train(docs.where(~held_out))
    found = docs.select(
        "doc_id", held_out.alias("held_out"), langid.predict(spark, model, "text").alias("p")
    )
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


@_register
def op7_bpe_encode(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = bpe.BpeModel.from_file(tokenizer_path())
    digest = bpe.encode_digest(spark, model, "text").alias("d")
    return docs.select("doc_id", digest).select("doc_id", "d.*")


@_register
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    benchmark = decontaminate.Benchmark(read_table(spark, folder, "benchmark"))
    digest = decontaminate.hit_digest(benchmark, "text").alias("d")
    found = docs.select("doc_id", digest).select("doc_id", "d.*")
    return found.withColumn("contaminated", F.col("n_hit") > 0)


@_register
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = secrets.train(docs)
    digest = secrets.secret_digest(spark, model, "text").alias("d")
    return docs.select("doc_id", digest).select("doc_id", "d.*")


@_register
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = lines.dedup_lines(docs)
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    return found.select(
        "doc_id",
        n_lines.alias("n_lines"),
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@_register
def op11_pstable_links(spark: SparkSession, folder: str) -> DataFrame:
    return pstable.near_duplicates(read_table(spark, folder, "embeddings"))


@_register
def op12_fptree_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return fptree.rank_documents(docs, read_table(spark, folder, "benchmark"))


@_register
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = [*fields[:3], F.col("n_chars") + 1, fields[4]]
    # without n_chars nothing is tampered with
    tampered = tampered & F.col("n_chars").isNotNull()
    leaf = merkle.row_digest(*fields)
    shown = F.when(tampered, merkle.row_digest(*more))
    found = merkle.manifest(docs, F.col("lang"), F.col("doc_id"), leaf, shown=shown)
    folded = merkle.fold(F.coalesce("shown", "leaf"), "path")
    found = found.withColumn("folded", folded)
    return found.select(
        F.col("id").alias("doc_id"),
        *[merkle.hex_text(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.proof_text("path").cast("binary"), 256).alias("proof_sha256"),
        merkle.hex_text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


SQL["op10_line_dedup"] = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents
), cut AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM docs
), placed AS (
  SELECT *, coalesce(sum(length(line)) OVER (
      PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM cut WHERE trim(line) <> ''
), spans AS (
  SELECT doc_id, start = 0 AS whole, sum(length(line)) OVER run AS size,
    list(line) OVER run AS run, list(pos) OVER run AS places
  FROM placed
  WINDOW run AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING)
  UNION ALL
  SELECT doc_id, FALSE, sum(length(line)) OVER run, list(line) OVER run, list(pos) OVER run
  FROM (SELECT *, start + length(line) AS stop FROM placed)
  WINDOW run AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN 19 PRECEDING AND CURRENT ROW)
), ranked AS (
  SELECT doc_id, places, rank() OVER (PARTITION BY run ORDER BY doc_id, places[1]) AS nth
  FROM spans WHERE size >= 20 OR whole
), gone AS (
  SELECT DISTINCT doc_id, unnest(places) AS pos FROM ranked WHERE nth > 1
), rest AS (
  SELECT c.doc_id, count(g.pos) AS n_removed,
    string_agg(c.line, chr(10) ORDER BY c.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM cut c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.pos = g.pos
  GROUP BY c.doc_id
)
SELECT d.doc_id, CAST(len(d.parts) AS BIGINT) AS n_lines, CAST(r.n_removed AS BIGINT) AS n_removed,
  sha256(coalesce(r.kept, '')) AS kept_sha256
FROM docs d JOIN rest r ON d.doc_id = r.doc_id
"""

SQL["op8_decontaminate"] = r"""
WITH fixed AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower,
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower), word) AS w
  FROM documents, fixed
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, upper, lower), word) AS w
  FROM benchmark, fixed WHERE text IS NOT NULL
), items AS (
  SELECT DISTINCT item, w[i + 1 : i + 10] AS part
  FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(part) AS size FROM items
), places AS (
  SELECT doc_id, p, size, w[p + 1 : p + size] AS part
  FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS p
        FROM d JOIN sizes ON len(w) >= size)
), hits AS (
  SELECT doc_id, p, size, item FROM places JOIN items USING (part)
), words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS word FROM (SELECT DISTINCT doc_id, p, size FROM hits))
  GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SQL["op13_merkle_manifest"] = """
WITH RECURSIVE enc AS (
  SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS id_text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') AS head,
    coalesce(strlen(lang) || ':' || lang, '-') AS g,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), marked AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      flatten(list_transform(string_split(id_text, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END),
    4294967295) % 7 = 0 AS bad
  FROM enc
), leaves AS (
  SELECT doc_id, lang, g, sha256(head || g || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || g || coalesce(strlen(CAST(n_chars + CAST(bad AS INT) AS VARCHAR)) || ':' || (n_chars + CAST(bad AS INT)), '-')
      || tail) AS shown
  FROM marked
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n, row_number() OVER () AS rid
  FROM leaves
), t AS (
  SELECT g, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT a.g, a.lvl + 1, a.pos // 2, (a.n + 1) // 2, sha256(a.h || coalesce(b.h, ''))
  FROM t a LEFT JOIN t b ON a.g = b.g AND b.pos = a.pos + 1
  WHERE a.n > 1 AND a.pos % 2 = 0
), subs AS (
  SELECT g, h, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM t JOIN (SELECT DISTINCT g, lang FROM leaves) USING (g) WHERE n = 1
), u AS (
  SELECT 0 AS lvl, pos, n, h FROM subs
  UNION ALL
  SELECT a.lvl + 1, a.pos // 2, (a.n + 1) // 2, sha256(a.h || coalesce(b.h, ''))
  FROM u a LEFT JOIN u b ON b.pos = a.pos + 1
  WHERE a.n > 1 AND a.pos % 2 = 0
), sides AS (
  SELECT a.g, a.lvl, a.pos, coalesce(b.h, '') AS h, a.pos % 2 = 1 AS before
  FROM t a LEFT JOIN t b ON b.g = a.g AND b.lvl = a.lvl AND b.pos = xor(a.pos, CAST(1 AS BIGINT))
  WHERE a.n > 1
), upper_sides AS (
  SELECT a.lvl, a.pos, coalesce(b.h, '') AS h, a.pos % 2 = 1 AS before
  FROM u a LEFT JOIN u b ON b.lvl = a.lvl AND b.pos = xor(a.pos, CAST(1 AS BIGINT))
  WHERE a.n > 1
), steps AS (
  SELECT p.rid, s.lvl, s.h, s.before
  FROM placed p JOIN sides s ON s.g = p.g AND s.pos = p.pos >> s.lvl
  UNION ALL
  SELECT p.rid, 1000 + s.lvl, s.h, s.before
  FROM placed p JOIN subs b ON b.g = p.g JOIN upper_sides s ON s.pos = b.pos >> s.lvl
), paths AS (
  SELECT rid, string_agg(h, '' ORDER BY lvl) AS proof,
    list(CASE WHEN before THEN '<' ELSE '>' END || h ORDER BY lvl) AS way
  FROM steps GROUP BY rid
), folded AS (
  SELECT p.doc_id, p.leaf, b.h AS subroot, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(p.shown, coalesce(way, [])),
      lambda a, x: sha256(CASE WHEN x[1] = '<' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM placed p JOIN subs b USING (g) LEFT JOIN paths USING (rid)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM folded, (SELECT h AS root FROM u WHERE n = 1)
"""

SQL["op11_pstable_links"] = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER () AS rid
  FROM embeddings
), able AS MATERIALIZED (
  SELECT * FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
    AND len(list_filter(e, lambda x: isfinite(x))) = len(e)
), pairs AS MATERIALIZED (
  SELECT a.rid AS a, b.rid AS b FROM able a JOIN able b ON a.label = b.label AND a.rid <> b.rid
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 END
), reach AS (
  SELECT rid, rid AS other FROM able
  UNION
  SELECT r.rid, p.b FROM reach r JOIN pairs p ON p.a = r.other
), grouped AS (
  SELECT r.rid, min(o.vec_id) AS least FROM reach r JOIN able o ON o.rid = r.other GROUP BY r.rid
), counted AS (
  SELECT a AS rid, count(*) AS n FROM pairs GROUP BY a
), joined AS (
  SELECT v.vec_id, coalesce(n, 0) AS n_links, CASE WHEN g.rid IS NULL THEN v.vec_id ELSE least END AS component_id
  FROM v LEFT JOIN grouped g USING (rid) LEFT JOIN counted c USING (rid)
)
SELECT *, component_id IS NOT DISTINCT FROM vec_id AS kept FROM joined
"""

SQL["op12_fptree_search"] = r"""
WITH fixed AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower,
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word
), d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), upper, lower), word) AS w
  FROM documents, fixed
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM d WHERE len(w) > 0
), b AS MATERIALIZED (
  SELECT item_id, row_number() OVER () AS iid,
    regexp_extract_all(translate(text, upper, lower), word) AS w
  FROM benchmark, fixed WHERE text IS NOT NULL
), asked AS (
  SELECT iid, term, count(*) AS times FROM (SELECT iid, unnest(w) AS term FROM b) GROUP BY ALL
), held AS (
  SELECT rid, term, count(*) AS tf
  FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM held, totals GROUP BY term, n_docs
), sizes AS (
  SELECT rid, doc_id, 25 + (75 * len(w) * n_docs) // n_all AS m FROM d, totals WHERE len(w) > 0
), scored AS (
  SELECT iid, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (rid)
  GROUP BY iid, rid, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM ranked JOIN b USING (iid) WHERE rank <= 10
"""
