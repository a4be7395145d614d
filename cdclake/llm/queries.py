"""The operators of this package on their tables: queries, and SQL giving the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm import (
    decontaminate, embeddings, jaccard, language, packing, paragraphs, quality, secrets, spelling, substrings, toxicity, warc, whitening,
)
from cdclake.llm.tables import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", *substrings.span_counts(), "kept_sha256", "spans")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit",
        F.size("contamination.item_ids").cast("long").alias("n_items"),
        "contamination.items_sha256", "contamination.contaminated",
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs.select("doc_id", "text"), language.learn(docs))
    return found.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(True)).alias("held_out"), "language.lang_pred", "language.score"
    )


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(True)).alias("held_out"), "toxicity.score", "toxicity.predicted"
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", "fingerprint", "score", "secret")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.ngram_join(_table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "outside")])


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.count_words(_table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_language_id": op3_language_id,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_secret_scan": op6_secret_scan,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_quality_rules": op11_quality_rules,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_WORDS = """regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

SQL: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f""",
    "op4_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= CAST(0.93 AS DOUBLE)),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM v
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
groups AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component AS component_id, component = v.vec_id AS kept
FROM v JOIN groups ON node = v.vec_id LEFT JOIN counts ON a = v.vec_id""",
    "op7_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
named AS (SELECT doc_id, w, array_to_string(w, ' ') AS seq FROM words),
classes AS (SELECT seq, min(doc_id) AS rep, count(*) AS copies FROM named WHERE len(w) > 0 GROUP BY seq),
texts AS (SELECT DISTINCT c.rep, n.w FROM classes c JOIN named n ON n.doc_id = c.rep),
shingles AS (
  SELECT DISTINCT rep, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts) x),
sizes AS (SELECT rep, count(*) AS n FROM shingles GROUP BY rep),
shared AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS both
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rep <> b.rep GROUP BY a.rep, b.rep),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.rep = s.a JOIN sizes y ON y.rep = s.b
  WHERE CAST(s.both AS DOUBLE) / (x.n + y.n - s.both) >= CAST(0.8 AS DOUBLE)),
reach AS (
  SELECT rep AS node, rep AS other FROM classes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
groups AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
counts AS (SELECT l.a AS rep, sum(c.copies) AS n FROM links l JOIN classes c ON c.rep = l.b GROUP BY l.a)
SELECT d.doc_id, coalesce(c.rep, d.doc_id) AS class_id,
  CAST(coalesce(c.copies, 1) - 1 + coalesce(k.n, 0) AS BIGINT) AS n_links,
  coalesce(g.component, d.doc_id) AS component_id, d.doc_id = coalesce(g.component, d.doc_id) AS kept
FROM named d LEFT JOIN classes c ON c.seq = d.seq AND len(d.w) > 0
LEFT JOIN counts k ON k.rep = c.rep LEFT JOIN groups g ON g.node = c.rep""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
        FROM items WHERE len(w) > 0) x),
sizes AS (SELECT DISTINCT size FROM windows),
found AS (
  SELECT doc_id, i, s.size, array_to_string(w[i:i + s.size - 1], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) x, sizes s
  WHERE i + s.size - 1 <= len(w)),
hits AS (SELECT f.doc_id, f.i, f.size, w.item FROM found f JOIN windows w ON f.size = w.size AND f.win = w.win),
words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) x GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op12_spelling_variants": """
WITH RECURSIVE steps(k, i, c) AS (
  SELECT 0, i, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL
  SELECT k + 1, i, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE k < 8),
tbl AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run
  FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
bytes AS (
  SELECT doc_id, run, n, list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''), lambda x: ord(x)) AS points FROM pairs),
sums AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(
    flatten([[CAST(4294967295 AS BIGINT)], flatten(list_transform(points,
      lambda p: CASE WHEN p < 128 THEN [CAST(p AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(p - 64 AS BIGINT)] END))]),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h
  FROM bytes, tbl),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM sums),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (
  SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) AS ahead, substr(word, i + 1) AS behind
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) x),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b
    ON a.size = b.size AND a.i = b.i AND a.ahead = b.ahead AND a.behind = b.behind AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.ahead || a.behind = b.word
  UNION
  SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.ahead || a.behind = b.word),
ranked AS (
  SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS place
  FROM near),
best AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word),
chain AS (
  SELECT word, word AS root FROM best
  UNION ALL
  SELECT c.word, b.form FROM chain c JOIN best b ON b.word = c.root WHERE b.form IS NOT NULL),
last AS (SELECT c.word, c.root FROM chain c JOIN best b ON b.word = c.root WHERE b.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM best JOIN last USING (word)""",
}
