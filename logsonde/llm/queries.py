"""The registered queries of the operators of this folder, and their SQL where it exists."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logsonde.llm.common import shared_folder, table
from logsonde.llm.decontamination import find_items
from logsonde.llm.embedding_links import embedding_links
from logsonde.llm.hard_negatives import mine_negatives
from logsonde.llm.ngram_join import ngram_links
from logsonde.llm.packing import pack
from logsonde.llm.personal_data import find_personal_data, fit_field
from logsonde.llm.phrase_mining import mine_phrases
from logsonde.llm.placement import Tree, place
from logsonde.llm.quality import fit_quality, rate_quality
from logsonde.llm.secrets_scan import scan_secrets
from logsonde.llm.token_counts import count_tokens
from logsonde.llm.token_ids import tokenizer_path, tokenizer_pattern
from logsonde.llm.token_output import read_tokens, write_tokens
from logsonde.llm.window_packing import pack_online

BYTE_RANKS = "byte_bpe_50k.tiktoken"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
SHARDS = 16


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents as coded blocks, reads the blocks back, and sums up each document."""
    path = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(WORD_TOKENIZER), end_id=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), end_id=0, capacity=2048)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document, how many of its words are in a run of benchmark words, and of which items."""
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


#: Every window of every item against every window of every document, of all lengths that item windows have.
OP4_SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), doc_window AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item_window))
), hit AS (
  SELECT d.r, d.i, d.n, w.item_id FROM doc_window d JOIN item_window w ON d.n = w.n AND d.run = w.run
), hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document, the scorer's probability that it is junk or toxic, and whether it is kept."""
    docs = table(spark, sf_dir, "documents")
    return rate_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document, its class of equal shingle sets, its links of similarity 0.8 or more and their component."""
    return ngram_links(table(spark, sf_dir, "documents"), threshold=0.8, shingle=5).drop("text_hash", "component")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the fixed forms, and all spans."""
    return scan_secrets(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_RANKS))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by key, and where each goes with a shard more."""
    tree = Tree.even(SHARDS)
    placed = place(table(spark, sf_dir, "documents"), tree, tree.grown())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vector, its links of cosine 0.93 or more within its label, and the component that they make."""
    return embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the fixed forms, and all spans."""
    docs = table(spark, sf_dir, "documents")
    return find_personal_data(docs, fit_field(docs))


def op11_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 2048 tokens, packed as the documents come."""
    ranks, pattern = tokenizer_path(BYTE_RANKS), tokenizer_pattern()
    return pack_online(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), ranks, pattern, end_id=1)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of each language, by their collocation score."""
    return mine_phrases(table(spark, sf_dir, "documents"), least=100, depth=5, top=2000)


#: All phrases of one to five words of all pieces, counted; every cut of every frequent one.
OP12_SQL = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
    FROM documents)
), gram AS (
  SELECT lang, d, array_to_string(w[i:i + d - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, d, unnest(range(1, len(w) - d + 2)) AS i FROM piece, (SELECT unnest(range(1, 6)) AS d))
  GROUP BY lang, d, phrase
), total AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE d = 1 GROUP BY lang
), candidate AS (
  SELECT lang, d, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE d > 1 AND f >= 100
), cut AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n, (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, d)) AS k FROM candidate) c
  JOIN gram l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') AND l.d = k
  JOIN gram r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.d], ' ') AND r.d = c.d - k
  JOIN total t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), open AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM candidate q WHERE q.lang = p.lang AND len(q.w) > len(string_split(p.phrase, ' ')) AND 100 * q.a >= 100 * p.a
      AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score
FROM open QUALIFY rank <= 2000
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector and each of its five positives, five vectors of other labels that score nearly as high."""
    return mine_negatives(
        table(spark, sf_dir, "embeddings"),
        is_anchor=lambda vec_id: vec_id % 100 == 0,
        relabel=lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
    )


#: The anchors' scores against all rows.
OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.w, b.w) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_ngram_join": op6_ngram_join,
    "op7_secrets": op7_secrets,
    "op8_sharding": op8_sharding,
    "op9_embedding_links": op9_embedding_links,
    "op10_personal_data": op10_personal_data,
    "op11_online_packing": op11_online_packing,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op4_decontamination": OP4_SQL,
    "op12_phrase_mining": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
