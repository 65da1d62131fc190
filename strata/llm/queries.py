"""One query per operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, html_text, license_scan, link_trust, merkle, mixing, packing, rules, search, sharding, simhash, subword, tokenout
from strata.llm.common import table


def op1_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op2_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_simhash_byte_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op5_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels"))


def op7_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text")).drop("detections")


def op8_context_mixing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenout.write_and_read(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels"))


def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"),
                                      table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_length_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build(table(spark, sf_dir, "documents", "doc_id", "text"))
    return search.search(index, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False)


def op13_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *merkle.LEAF_COLUMNS)
    return merkle.prove(merkle.build(docs, merkle.without_line_ends()), with_proofs=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_link_trust": op1_link_trust,
    "op2_feistel_sharding": op2_feistel_sharding,
    "op3_simhash_byte_index": op3_simhash_byte_index,
    "op4_sainte_lague_mixing": op4_sainte_lague_mixing,
    "op5_min_cut_text": op5_min_cut_text,
    "op6_decision_list_rules": op6_decision_list_rules,
    "op7_license_rules": op7_license_rules,
    "op8_context_mixing_ids": op8_context_mixing_ids,
    "op9_subword_classifier": op9_subword_classifier,
    "op10_spaced_seed_decontamination": op10_spaced_seed_decontamination,
    "op11_length_stratified_search": op11_length_stratified_search,
    "op12_hilbert_packing": op12_hilbert_packing,
    "op13_octopus_manifest": op13_octopus_manifest,
}
