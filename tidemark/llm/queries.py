"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, bpe, chat, html, language_model, mixing, negatives, passages, pivots, quality, rules, simhash, warc,
)
from tidemark.llm.registry import ORACLES, QUERIES, query
from tidemark.plans.inputs import table

__all__ = ["ORACLES", "QUERIES"]


@query("op1_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_lm_score")
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op4_bpe_tokens")
def bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(bpe.VOCABULARY)
    return bpe.digests(bpe.encode_texts(table(spark, sf_dir, "documents"), path, decoded=True))


@query("op5_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html.extract(table(spark, sf_dir, "pages"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))


@query("op6_embedding_dedup")
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


_CONTROL = r"""'([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g'"""

_CHAT_SQL = rf"""WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
messages AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
marked AS (
  SELECT *, length(regexp_replace(text, {_CONTROL})) AS escaped,
    length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), {_CONTROL})) AS named
  FROM messages)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + named + 1 + escaped + 11) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""


@query("op7_chat_format", _CHAT_SQL)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digests(chat.render(chat.fold(chat.event_log(rows))))


@query("op8_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    return judged.drop("lang", "source")


@query("op9_source_mix", mixing.MIX_SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


_REPEATS_SQL = r"""WITH split AS (
  SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT nr, unnest(range(1, len(words) - 33)) AS first, words FROM split WHERE len(words) >= 35),
windows AS (SELECT nr, first, sha256(array_to_string(list_slice(words, first, first + 34), ' ')) AS said FROM starts),
repeated AS (SELECT nr, first FROM windows QUALIFY count(*) OVER (PARTITION BY said) > 1),
gone AS (SELECT DISTINCT nr, unnest(range(first, first + 35)) AS i FROM repeated),
placed AS (SELECT nr, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
kept AS (
  SELECT p.nr, count(*) AS n_kept, string_agg(p.word, ' ' ORDER BY p.i) AS said
  FROM placed p ANTI JOIN gone g ON p.nr = g.nr AND p.i = g.i GROUP BY p.nr)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(len(s.words) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.said, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.nr = k.nr"""


@query("op10_substring_dedup", _REPEATS_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return passages.remove_repeats(docs, passages.digest, "n_words long, n_removed long, kept_sha256 string")


_WARC_SQL = """WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
    row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS nth,
    first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS first_id
  FROM pages)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nth > 1 THEN first_id END AS refers_to
FROM payloads"""


@query("op11_warc_archives", _WARC_SQL)
def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.page_digests(warc.read_archives(manifest, payloads=False))


@query("op12_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = (public_tokenizers.path(x) for x in (alignment.LEFT, alignment.RIGHT))
    return alignment.alignment(table(spark, sf_dir, "documents"), left, right)


_NEGATIVES_SQL = """WITH usable AS (
  SELECT row_number() OVER () AS nr, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.nr AS anchor, a.vec_id AS anchor_id, c.nr, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.nr <> c.nr AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, nr) AS nth
  FROM scored WHERE same QUALIFY nth <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY n.score DESC, n.vec_id NULLS LAST, n.nr) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor
WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""


@query("op13_hard_negatives", _NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.usable(table(spark, sf_dir, "embeddings").withColumn("label", label))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
