"""The operators as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from amberline.llm import (
    block_search,
    bpe,
    collocations,
    embeddings,
    html_text,
    jaccard,
    length_buckets,
    licences,
    quality_lines,
    token_files,
    toxicity,
    turn_repair,
    warc,
)
from amberline.llm.common import table

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "lost")
    return quality_lines.clean(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *figures)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    offsets = "array_join(transform(spans, s -> concat(s.start, '-', s.stop)), ',') AS spans"
    return scored.selectExpr("doc_id", "held_out", "score", "predicted", "cast(size(spans) as long) AS n_spans", offsets)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"), percent=90, size=3)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.top_k(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_quality,
        op3_toxicity,
        op4_bpe,
        op5_jaccard,
        op6_token_files,
        op7_packing,
        op8_html,
        op9_licences,
        op10_embeddings,
        op11_turn_repair,
        op12_top_k,
        op13_collocations,
        pipeline,
    )
}
