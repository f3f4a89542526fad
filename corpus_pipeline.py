"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's docs. All but the last return the columns of
documents and no others. A document is its doc_id: rows that repeat an id are
judged each by its own text, but are no duplicates of each other; rows without
one pass the stages that compare documents. Without rows each stage gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, lines, neardup, packing, quality
from tidemark.llm.runtime import store, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; a null or empty text is not kept."""
    return quality.judged(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring lines; a document all of whose lines are gone goes too. n_chars of a changed text is counted anew."""
    left = lines.deduped(docs.select(*COLUMNS)).filter((F.col("n_lines") == 0) | (F.col("n_lines") > F.col("n_dropped")))
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; texts without words link with nothing and stay."""
    gone = neardup.labelled(docs).filter(F.col("doc_id") > F.col("component_id")).select(F.col("doc_id").alias("g_doc"), F.col("row_key").alias("g_row")).distinct()
    return docs.join(store(gone, "near-duplicates"), (F.col("doc_id") == F.col("g_doc")) & (F.xxhash64("text") == F.col("g_row")), "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with the benchmark; the text of those that stay is not changed."""
    found = contamination.verdicts(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias("g_doc"), F.col("row_key").alias("g_row")).distinct()
    return docs.join(store(found, "contaminated"), F.col("doc_id").eqNullSafe(F.col("g_doc")) & (F.xxhash64("text") == F.col("g_row")), "left_anti").select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
