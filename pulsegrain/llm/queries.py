"""One query per operator of this subpackage over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm import toxicity, warc
from pulsegrain.llm.conversations import repair_report
from pulsegrain.llm.html_text import main_text
from pulsegrain.llm.merkle import fingerprint_report
from pulsegrain.llm.mixing import mix_report
from pulsegrain.llm.neighbours import nearest
from pulsegrain.llm.pieces import encoded
from pulsegrain.llm.pii import pii_report
from pulsegrain.llm.quality import quality_verdicts
from pulsegrain.llm.shared import table, tuned
from pulsegrain.llm.similar import similar_documents
from pulsegrain.llm.substrings import without_repeats
from pulsegrain.llm.whitening import whitened

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_verdicts(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "p_good")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).drop("n_shared")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted",
                        F.size("offending").cast("long").alias("n_offending"))


def op4_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), MODEL_FILE)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(pages)
    found = warc.captures(archives, pages.select(warc.url_key("url").alias("key")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents")).drop("edit")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_html": op2_html,
    "op3_toxicity": op3_toxicity,
    "op4_similar": op4_similar,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_pieces": op7_pieces,
    "op8_warc": op8_warc,
    "op9_substrings": op9_substrings,
    "op10_pii": op10_pii,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_conversations": op13_conversations,
}
QUERIES = {name: tuned(query) for name, query in QUERIES.items()}
ORACLE = {
    "op4_similar": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d
LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)""",
    "op8_warc": """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), equal AS (SELECT digest, max(page_id) AS original FROM sized WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM sized LEFT JOIN equal USING (digest)""",
    "op11_merkle": r"""
WITH following AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER w,
    first_value(coalesce(text, '')) OVER w) AS next_text,
    coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
  FROM documents WINDOW w AS (ORDER BY doc_id DESC)
), texts AS (
  SELECT doc_id, false AS edited, text FROM following
  UNION ALL SELECT doc_id, true, left(text, length(text) - length(text) // 3) || left(next_text, length(text) // 3)
  FROM following
), leaves AS (
  SELECT doc_id, edited, text, list_transform(regexp_extract_all(text, '[^.!?\n]{1,128}[.!?\n]*|[.!?\n]+'),
    lambda p: {'d': sha256(p), 'n': least(length(p), 1048575), 'closes': contains(p, chr(10)),
               'blank': contains(p, chr(10) || chr(10))}) AS l FROM texts
), paragraph_ends AS (
  SELECT *, list_filter(generate_series(1, len(l)), lambda k: k = len(l) OR l[k].closes) AS e FROM leaves
), paragraphs AS (
  SELECT doc_id, edited, text, list_distinct(list_transform(l,
      lambda x: ('0x' || substr(x.d, 1, 10))::BIGINT * 1048576 + x.n)) AS keys,
    list_transform(list_transform(e, lambda k, i: l[CASE WHEN i = 1 THEN 1 ELSE e[i - 1] + 1 END:k]),
      lambda g: {'d': sha256(array_to_string(list_transform(g, lambda x: x.d), '')),
        'closes': g[len(g)].blank OR substr(g[len(g)].d, 1, 1) IN ('0', '1', '2', '3'),
        'code': array_to_string(list_transform(g, lambda x: substr(x.d, 1, 10) || ':' || x.n), ' ')}) AS l
  FROM paragraph_ends
), section_ends AS (
  SELECT *, list_filter(generate_series(1, len(l)), lambda k: k = len(l) OR l[k].closes) AS e FROM paragraphs
), sections AS (
  SELECT doc_id, edited, text, keys,
    list_transform(list_transform(e, lambda k, i: l[CASE WHEN i = 1 THEN 1 ELSE e[i - 1] + 1 END:k]),
      lambda g: {'d': sha256(array_to_string(list_transform(g, lambda x: x.d), '')),
        'code': array_to_string(list_transform(g, lambda x: x.code), ',')}) AS l
  FROM section_ends
), trees AS (
  SELECT doc_id, edited, text, keys, sha256(array_to_string(list_transform(l, lambda x: x.d), '')) AS root,
    array_to_string(list_transform(l, lambda s: '|' || substr(s.d, 1, 16) || '(' || s.code || ')'), '') AS code,
    coalesce(list_sum(list_transform(keys, lambda k: k & 1048575)), 0) AS weight
  FROM sections
)
SELECT a.doc_id, length(a.text) AS n_chars, sha256(b.text) AS edited_sha256, a.root || a.code AS fingerprint,
  b.root || b.code AS edited_fingerprint,
  CASE WHEN a.root = b.root THEN 1.0::DOUBLE ELSE 2 * coalesce(list_sum(list_transform(
    list_intersect(a.keys, b.keys), lambda k: k & 1048575)), 0)::DOUBLE / (a.weight + b.weight) END AS near_edited,
  CASE WHEN a.root = c.root THEN 1.0::DOUBLE ELSE 2 * coalesce(list_sum(list_transform(
    list_intersect(a.keys, c.keys), lambda k: k & 1048575)), 0)::DOUBLE / (a.weight + c.weight) END AS near_next
FROM trees a JOIN trees b ON a.doc_id = b.doc_id AND b.edited JOIN following f ON a.doc_id = f.doc_id
JOIN trees c ON c.doc_id = f.next_id AND NOT c.edited WHERE NOT a.edited""",
}
