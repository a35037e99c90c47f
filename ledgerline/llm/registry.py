"""The registered queries of this subpackage and, where SQL can express one, its SQL answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    answers,
    chat_format,
    conversation_repair,
    decontaminate,
    html_text,
    merkle,
    packing,
    pii,
    quality,
    quality_rules,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
)
from ledgerline.llm.common import table
from ledgerline.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


@registered
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


@registered
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.digests(token_files.read_tokens(spark, path))


@registered
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extracted(pages, html_text.train(pages))


@registered
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@registered
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    return decontaminate.report(found)


@registered
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.verified(docs, pii.run_key(spark))
    shown = F.transform("entities", lambda e: F.struct(e["type"], e["start"], e["end"], e["surrogate"]))
    n_entities = F.size("entities").cast("long").alias("n_entities")
    return found.select("doc_id", "text", n_entities, shown.alias("entities"), "n_occurring")


@registered
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.verdicts(quality.scored(docs, trees))


@registered
def op10_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@registered
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversation_repair.reports(conversation_repair.damaged(given), every=given)


@registered
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"), scratch_path(spark, "manifest"))


@registered
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "chat")
    chat_format.formatted(chat_format.with_trap(table(spark, sf_dir, "conversations"))).write.parquet(path)
    return chat_format.digests(spark.read.parquet(path))


ANSWERS["op11_conversation_repair"] = answers.CONVERSATION_REPAIR
ANSWERS["op12_merkle_manifest"] = answers.MERKLE_MANIFEST
ANSWERS["op13_chat_format"] = answers.CHAT_FORMAT
