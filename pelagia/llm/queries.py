"""The driver's queries over the training-data operators, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pelagia.llm import chat, decontam, filter_audit, licenses, merkle, minhash, mixing, packing, passages, pii, spotsigs, toxicity, urls

#: Shares of the tokens of the mixed corpus, by domain.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the documents in the labels table: their language."""
    return docs.where("lang is not null").select("doc_id", docs["lang"].alias("domain")).join(labels.select("doc_id").distinct(), "doc_id")


def op1_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=pii.session_key(spark), count="n_replaced")


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(_table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recover_turns(_table(spark, sf_dir, "conversations"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(_table(spark, sf_dir, "documents"), keep_text=False).drop("kept_text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, labelled_domains(docs, _table(spark, sf_dir, "labels")), TARGETS)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op11_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query needs the vocabulary files

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.build(_table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_feistel_pii, op2_spotsigs, op3_chat_format, op4_minhash_dedup, op5_toxicity,
        op6_substring_dedup, op7_decontaminate, op8_mixing, op9_url_filter, op10_license_scan,
        op11_retrieval_packing, op12_filter_audit, op13_merkle_manifest,
    )
}
ORACLE_SQL = {
    "op4_minhash_dedup": minhash.OP4_SQL,
    "op6_substring_dedup": passages.OP6_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
