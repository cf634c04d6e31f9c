"""The registered queries: each operator over its whole table, and the digest columns of its result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (binary, bpe, divergence, exact, langid, packing, pii, simhash, substring, suffixes, toxicity,
                          trie, vectors)
from eventide.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, max_bits=3)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.drop_repeats(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = binary.pack_matrix(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("sequence_id", "n_tokens", "cu_seqlens", "doc_ids", "starts",
                      F.crc32("ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32"))


def op11_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.drop_repeated_bytes(table(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_substring, op3_packing, op4_exact, op5_vectors, op6_langid,
                                   op7_toxicity, op8_pii, op9_bpe, op10_binary, op11_suffix, op12_divergence,
                                   op13_trie)}
