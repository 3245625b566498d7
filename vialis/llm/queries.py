"""Registered queries of the text-collection operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis.llm import (
    chat_prefix, decontaminate, langid, license_scan, line_dedup, mixing, ngram_join, periodic_runs, pii, secret_scan,
    sharding, topk, whitening,
)
from vialis.llm.common import table


def op1_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the examples of all conversations and of one whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat_prefix.digest(chat_prefix.examples(turns.unionByName(odd)))


OP1_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
s AS (
  SELECT *, row_number() OVER o AS i,
    length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))
      + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) + 13 AS chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto, max(i) OVER (PARTITION BY conv_id) AS n FROM s)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant' OR i = n) AS n_examples
FROM p GROUP BY conv_id"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that repeat an earlier line, nearly or exactly."""
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


# Sets share a word among the rarest n - ceil(0.8 n) + 1, whatever order breaks ties.
OP2_SQL = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line, unnest(parts) AS words FROM d),
s AS (
  SELECT doc_id, line, list_sort(list_distinct(list_filter(
    string_split(translate(lower(words), chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), lambda w: w <> ''))) AS ws FROM l),
g AS (
  SELECT ws, min((doc_id, line)) AS first, row_number() OVER (ORDER BY min((doc_id, line))) AS id, len(ws) AS n
  FROM s WHERE len(ws) > 0 GROUP BY ws),
w AS (SELECT id, n, unnest(ws) AS word FROM g),
f AS (SELECT word, count(*) AS df FROM w GROUP BY word HAVING count(*) > 0),
p AS (
  SELECT id, n, word FROM w JOIN f USING (word)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY df, word) <= n - ((4 * n + 4) // 5) + 1),
c AS (
  SELECT DISTINCT x.id AS earlier, y.id AS later FROM p x JOIN p y ON x.word = y.word AND x.id < y.id
  AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n),
m AS (
  SELECT DISTINCT later FROM c JOIN g x ON x.id = earlier JOIN g y ON y.id = later
  WHERE 9 * len(list_intersect(x.ws, y.ws)) >= 4 * (x.n + y.n)),
r AS (
  SELECT s.doc_id, s.line FROM s JOIN g USING (ws) LEFT JOIN m ON m.later = g.id
  WHERE m.later IS NOT NULL OR (s.doc_id, s.line) <> g.first),
a AS (SELECT doc_id, count(*) AS n_removed, string_agg(line, ',' ORDER BY line) AS removed FROM r GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS INTEGER) AS n_lines,
  CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN a ON a.doc_id = documents.doc_id"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and taken words of every document."""
    found = mixing.mix(table(spark, sf_dir, "documents")).rows
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.held_out("doc_id"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id, score FROM s
WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER o <= 10"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a benchmark item in a document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), keep_text=False, every_id=True)
    return marked.select("doc_id", F.inline("leaks"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with a periodic end."""
    found = periodic_runs.find(table(spark, sf_dir, "documents"), tail=periodic_runs.planted_tail)
    return periodic_runs.digest(found)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat_prefix": op1_chat_prefix,
    "op2_line_dedup": op2_line_dedup,
    "op3_secrets": op3_secrets,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op8_top_k": op8_top_k,
    "op9_ngram_join": op9_ngram_join,
    "op10_decontamination": op10_decontamination,
    "op11_license_scan": op11_license_scan,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}
SQL = {
    "op1_chat_prefix": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op8_top_k": OP8_SQL,
    "op11_license_scan": license_scan.as_sql(),
}
