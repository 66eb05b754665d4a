"""The queries opN_<name>: each operator over its whole table, as the digest that its contract asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from renown.llm import (class_lm, decontaminate, dialogue, merkle, order_minhash, packing, pii, secret_scan, simhash,
                        suffix_dedup, toxicity, url_filter, warc)
from renown.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_pairs(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_texts(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_report(table(spark, sf_dir, "conversations"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_decontaminate, op3_order_minhash, op4_toxicity, op5_simhash, op6_personal_data,
    op7_class_lm, op8_warc, op9_secrets, op10_packing, op11_dialogue_repair, op12_merkle, op13_url_filter)}
ORACLES = {"op2_decontaminate": decontaminate.SQL, "op8_warc": warc.SQL, "op11_dialogue_repair": dialogue.SQL,
           "op12_merkle": merkle.SQL}
