"""Queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, exact_dedup, hard_negatives, language_model, licenses, line_dedup, mixing, pii, simhash_dedup, suffix_dedup, toxicity, whitening
from ._common import documents


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


OP6_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keep_id FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, (r.k IS NOT NULL AND l.doc_id <> r.keep_id) AS gone FROM keyed l LEFT JOIN repeated r ON l.k = r.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))
    base = [k.name for k in pii.KINDS if k.base]
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(pii.listed(F.flatten(F.array(*base))), 256).alias("base_sha256"),
        pii.listed(F.flatten(F.array(*[k.name for k in pii.KINDS]))).alias("spans"),
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").unionByName(extra)
    return chat_format.read_back(chat_format.format_conversations(turns))


OP10_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length(text) + 2
    + len(regexp_extract_all(text, '\[/?INST\]|</?s>|<</?SYS>>|\[ROLE [A-Za-z0-9*_.+%-]*\]|\[/ROLE\]'))
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 14 + length(role) END AS n
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(n) + count(*) - 1)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = language_model.learned_scores(docs, ~language_model.held_out())
    return scored.select("doc_id", language_model.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(embeddings(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(embeddings(spark, sf_dir))


OP13_SQL = """
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_bool_or(list_transform(embedding, lambda x: coalesce(NOT isfinite(x), true)))
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM known a, known b WHERE a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_dedup": op1_simhash_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_license_scan": op7_license_scan,
        "op8_source_mixing": op8_source_mixing,
        "op9_personal_data": op9_personal_data,
        "op10_chat_format": op10_chat_format,
        "op11_language_model": op11_language_model,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": OP2_SQL,
        "op6_exact_dedup": OP6_SQL,
        "op10_chat_format": OP10_SQL,
        "op13_hard_negatives": OP13_SQL,
    }
