"""A corpus pipeline: quality rules, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet in the
shared folder and read again as the next stage's ``docs``. All but the last give the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.llm import jaccard, length_buckets, quality_lines, toxicity
from amberline.llm.common import saved, table

#: Documents with this Jaccard similarity of their shingles of so many words are near duplicates. (90 and 3 are op5's own.)
NEAR_PERCENT, NEAR_WORDS = 80, 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove failing lines; documents that the rules reject go. A document that loses no line keeps its text as it is."""
    rows = quality_lines.judged(docs).where(quality_lines.verdict())
    changed = F.col("n_lines_removed") > 0
    new = {"text": F.when(changed, F.col("clean_text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col("row.n_chars"))
    return rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores at its threshold or more go; rows with a null id stay."""
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    bad = scored.where("predicted = 1").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, and once; rows with a null id stay."""
    named = jaccard.join_similar(docs, percent=NEAR_PERCENT, size=NEAR_WORDS)
    copies = named.where("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    return left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id IS NULL"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return length_buckets.pack(docs)


STAGES = [("quality rules", quality), ("toxicity", toxic), ("n-gram Jaccard join", near_duplicates), ("packing", packing)]

#: The toxicity model has no form in SQL; the rows are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
