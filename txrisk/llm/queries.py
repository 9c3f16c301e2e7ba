"""Queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, conversation_repair, decontaminate, html_text, jaccard_join, language_model, licenses, merkle, quality, rule_ensemble, substring_dedup, token_counts
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.digests(found)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, keep=["doc_id"]).drop("blocks")


def op2_license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, keep=["doc_id"], passages=True).drop("blocks")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.with_limit(token_counts.count_tokens(docs, path, keep=["doc_id"]))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.score(docs, keep=["doc_id"])


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.join_classes(docs, keep=["doc_id"])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN, keep=["doc_id"]))


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judged(docs, keep=["doc_id"])


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs, keep=["doc_id"]).withColumnRenamed("clean", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audits(merkle.paths(merkle.build(table(spark, sf_dir, "documents"))))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.reports(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rule_ensemble.classified(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontamination, op2_license_scan, op2_license_passages, op3_token_counts, op4_html_text, op5_language_model, op6_jaccard_join, op7_bpe,
                                   op8_chat_perspectives, op9_quality_rules, op10_substring_dedup, op11_merkle_manifest, op12_conversation_repair, op13_rule_classifier)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": decontaminate.ORACLE.strip(),
            "op2_license_scan": licenses.oracle().strip(),
            "op6_jaccard_join": jaccard_join.ORACLE.strip(),
            "op8_chat_perspectives": chat.ORACLE.strip(),
            "op11_merkle_manifest": merkle.oracle().strip(),
            "op12_conversation_repair": conversation_repair.oracle().strip()}
