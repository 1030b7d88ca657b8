"""A training corpus from documents: five stages, each an operator of ``concord.llm``.

Every stage takes all rows that its predecessor kept. Its result is written as Parquet in the shared folder
and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import decontaminate, line_dedup, mixing, simhash_dedup, toxicity
from concord.llm._common import documents, staged, unstaged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels of ``docs``, does not predict toxic.

    Null and empty texts score like any text without a landmark. Repeated rows stay or go together, ties with the threshold go.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three of them share, but in the one that keeps them; no document goes.

    Null texts become empty ones. Rows that share a doc_id count as one document.
    """
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles at least 0.8 similar), the one with the smallest doc_id.

    Rows that share this doc_id all stay, and so do rows without an id if their whole group has none. Texts without words,
    null or not, are one group.
    """
    found = simhash_dedup.similar_texts(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.select(*COLUMNS).join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item, whole; those without an id or without words leak none."""
    leaked = staged(decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct(), "leaked")
    return docs.select(*COLUMNS).join(decontaminate._small(leaked), "doc_id", "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as dealt, by source weights: each row one time that a document is dealt, with its text and language.

    Documents without words go with their block, a source of such only is not dealt, null sources are one source.
    """
    docs = docs.select(*COLUMNS).withColumn("text_key", F.xxhash64("text", "lang"))
    dealt = mixing.mix(docs, keep=("text_key",)).withColumnRenamed("doc_id", "dealt_id").withColumnRenamed("text_key", "dealt_key")
    # the mix works on numbers; texts meet it once, at the end
    texts = docs.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"), F.first("lang").alias("lang"))
    same = F.col("dealt_id").eqNullSafe(F.col("doc_id")) & (F.col("dealt_key") == F.col("text_key"))
    return texts.join(dealt.hint("shuffle_hash"), same).drop("dealt_id", "dealt_key", "text_key")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
]

ORACLE_SQL = None  # the toxicity model and SimHash components have no SQL form; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the corpus as it is to be trained on. A stage's table goes once the next one is written.

    Every stage takes extra columns (they are left behind), empty tables (the result is empty) and texts of any length (they are read whole).
    """
    docs = before = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        unstaged(before)
        before = docs
    return docs
