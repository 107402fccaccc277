"""Queries of the training-data operators, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gridmix.llm import (
    ann, bpe, conversations, hard_negatives, jaccard_join, licenses, line_dedup, mixing, packing, page_lines, quality_model,
    quality_rules, revisits, token_frames)
from gridmix.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = quality_model.grades_of_labels(table(spark, sf_dir, "labels"))
    return quality_model.score(docs, quality_model.fit(docs, ratings, grades=3))


def op4_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_frames.digests(token_frames.round_trip(docs))


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return revisits.report(revisits.resolve(revisits.crawl(pages)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality_rules.verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, "vec_id % 20 = 0", k=20)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.join(docs, n=4, percent=85)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.clean(docs)


def op9_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_lines.clean(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return hard_negatives.mine(hard_negatives.flipped(vectors), "vec_id % 100 = 0")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(conversations.repair(conversations.damaged(rows)))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, places = packing.pack_documents(docs)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, QueryFn] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_quality_model": op3_quality_model,
    "op4_token_frames": op4_token_frames,
    "op5_revisits": op5_revisits,
    "op6_quality_rules": op6_quality_rules,
    "op7_nearest": op7_nearest,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op9_page_lines": op9_page_lines,
    "op10_poisson_mixing": op10_poisson_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_best_fit": op13_best_fit,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": licenses.SQL,
    "op5_revisits": revisits.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op9_page_lines": page_lines.SQL,
    "op10_poisson_mixing": mixing.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
