"""The registered queries of the training-data operators: one thin ``opN_<name>`` per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bourse.llm import conversation, decontam, html_text, lm, mixing, secret_scan, toxicity, warc, wavelet
from bourse.llm.common import table
from bourse.llm.embed_dedup import near_duplicate_vectors
from bourse.llm.filter_audit import filter_audit
from bourse.llm.filter_audit import oracle as audit_oracle
from bourse.llm.quality import quality_rules
from bourse.llm.simhash import simhash_components
from bourse.session import scratch_path, shared_dir


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    found = simhash_components(table(spark, sf_dir, "documents"), k=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    return wavelet.token_table(table(spark, sf_dir, "documents"), wavelet.tokenizer_file("word_bpe_49k.json"), end_id=1)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op8_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.drop("key")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_mix_sources": op2_mix_sources,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_wavelet_tokens": op4_wavelet_tokens,
    "op5_html_text": op5_html_text,
    "op6_toxicity_nnpu": op6_toxicity_nnpu,
    "op7_secret_scan": op7_secret_scan,
    "op8_winnowing_decontamination": op8_winnowing_decontamination,
    "op9_lm_scores": op9_lm_scores,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

LLM_ORACLE: dict[str, str] = {
    "op1_warc_round_trip": warc.oracle(),
    "op2_mix_sources": mixing.oracle(),
    "op7_secret_scan": secret_scan.oracle(),
    "op8_winnowing_decontamination": decontam.oracle(window=10),
    "op11_conversation_repair": conversation.oracle(),
    "op12_filter_audit": audit_oracle(),
}
