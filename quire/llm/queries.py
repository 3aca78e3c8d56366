"""The operators over the driver's tables, one query each, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .common import read
from .conversation_repair import damage, repair_conversations
from .decontaminate import contamination
from .line_dedup import line_dedup
from .lm_score import cross_entropy_difference, with_target
from .ngram_join import ngram_join
from .preference import other_answers, preference_pairs, turns_of
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .ranked_search import ranked_search
from .surrogates import replace_personal_data
from .token_counts import token_counts
from .url_filter import url_filter

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Key of the surrogates in op1; a user passes their own secret.
KEY = "an example key"
#: Fixed values of op10's contract.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_personal_data(docs, KEY)


def op2_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_round_trip(docs, vocabulary).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the host, the language within it the path."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality_classifier(docs, read(spark, sf_dir, "labels"), host="source", path="lang").drop("text")


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with another one's last answer."""
    return preference_pairs(other_answers(turns_of(read(spark, sf_dir, "conversations"))))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join(docs, size=4, percent=85)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules(docs).drop("text", "lang")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of quality; background: all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = with_target(docs, read(spark, sf_dir, "labels"), "quality = 1")
    return cross_entropy_difference(docs, "is_target").drop("text")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"), RULES).drop("url", "html")


def op11_token_counts(spark: SparkSession, sf_dir: str, model: str = PIECES) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, model).drop("text")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with faults put into them, repaired."""
    repaired = repair_conversations(damage(read(spark, sf_dir, "conversations")), absent="absent")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return repaired.withColumn("repaired_sha256", F.sha2(F.concat_ws("\n", lines), 256)).drop("turns")


QUERIES = {
    "op1_surrogates": op1_surrogates,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_preference": op5_preference,
    "op6_decontamination": op6_decontamination,
    "op7_ngram_join": op7_ngram_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_score": op9_lm_score,
    "op10_url_filter": op10_url_filter,
    "op11_token_counts": op11_token_counts,
    "op12_ranked_search": op12_ranked_search,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op3_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, i, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), shared AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, i, line, s.key IS NOT NULL AND l.doc_id <> s.first AS gone
  FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_ranked_search": r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), docs AS (SELECT r, doc_id, len(ws) AS n, ws FROM words WHERE len(ws) > 0),
total AS (SELECT count(*)::BIGINT AS N_, sum(n)::BIGINT AS L_ FROM docs),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tfs AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(ws) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, doc_id, n, term
), dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term),
shares AS (
  SELECT r, doc_id, term,
    floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * N_) // L_))) AS share
  FROM tfs JOIN dfs USING (term), total
), scored AS (
  SELECT item_id, r, doc_id, sum(share)::BIGINT AS score
  FROM wanted JOIN shares USING (term) GROUP BY item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 50""",
}
