"""Corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's docs. All but the last return the columns of
``documents``, extra ones under any names included. Empty tables give empty tables,
and texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import decontam_cgk, mixing, secret_ledger, simhash_gray, toxicity_knn
from rankforge.llm.common import is_remainder, read, unused, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go, at a cut that weighs toxic and clean labels alike.

    A null or empty text has the score of no neighbours; without usable labels all stay. Repeated rows stay or go together.
    """
    index = toxicity_knn.fit(docs, read(spark, sf_dir, "labels"), ~is_remainder("doc_id", 5, 0))
    return toxicity_knn.accepted(docs, index)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays (one row, where rows repeat; a group without ids keeps one).

    Texts without words, null ones too, are one group. Of rows with the smallest id, that with the smallest text hash stays.
    """
    row, words = unused(docs, "_rf_id"), unused(docs, "_rf_text")
    named = docs.withColumn(row, F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).withColumn(words, F.xxhash64("text"))
    rows = simhash_gray.near_duplicates(named.select("doc_id", "text", row, words), keep=["doc_id", row, words])
    stays = (rows.groupBy("component").agg(F.min_by(F.struct(row, words), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", words)).alias("s"))
             .select(f"s.{row}", f"s.{words}"))
    return named.join(stays, [row, words], "left_semi").dropDuplicates([row, words]).select(*(F.col(f"`{c}`") for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty ones hold none, and an empty benchmark takes none."""
    leaks = unused(docs, "_rf_leaks")
    return decontam_cgk.with_leaks(docs, read(spark, sf_dir, "benchmark"), out_col=leaks).where(F.size(leaks) == 0).drop(leaks)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, of overlapping ones the whole stretch; all documents stay, null texts as they are."""
    return secret_ledger.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; a null or blank text has size 0 and is not taken, a null source is a source."""
    return mixing.copies(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [("toxicity", toxicity), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontamination), ("secret_scans", secrets), ("mix", mix)]

#: The neighbours' votes, the fingerprints' hash and the edit distances have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
