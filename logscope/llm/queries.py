"""Registered queries of the corpus operators and their SQL, where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.sources import read_table

from .byte_bpe import encode_decode, ids_sha256
from .common import shipped
from .conversations import conversation_trie
from .decontamination import contamination
from .language import identify, page_evidence, train_text
from .licenses import scan_licenses
from .neighbours import nearest
from .ngram_lm import score_texts
from .packing import pack_documents
from .sharding import row_size, text_crc32, write_shards
from .simhash import simhash_groups
from .sql import CONVERSATION_TRIE
from .token_counts import count_tokens
from .toxicity import fit, held_out, score_toxicity
from .whitening import whiten

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SHINGLE_WORDS, SIMHASH_BITS, SHARDS = 4, 4, 24
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items found in it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "items", (F.size("items") > 0).alias("contaminated"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page (markup, address suffix and host) and every document (declared language, source as
    host); trained on all documents."""
    docs = read_table(spark, sf_dir, "documents")
    model = train_text(docs)
    none = lambda kind: F.lit(None).cast(kind)
    rows = page_evidence(read_table(spark, sf_dir, "pages")).select(
        none("long").alias("doc_id"), "page_id", "text", "declared", "host", "suffix").unionByName(
        docs.select("doc_id", none("long").alias("page_id"), "text", F.col("lang").alias("declared"),
                    F.col("source").alias("host"), none("string").alias("suffix")))
    out = identify(rows, model, "text", "declared", "host", "suffix")
    return out.select("doc_id", "page_id", "declared", "host", "language", "posterior", "accepted")


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(read_table(spark, sf_dir, "documents"), words=SHINGLE_WORDS, max_bits=SIMHASH_BITS)
    return out.select("doc_id", "fingerprint", "component_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = write_shards(read_table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    return shards.select("doc_id", row_size("text").alias("size"), text_crc32("text").alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "licenses", "matches", "unknown")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_texts(read_table(spark, sf_dir, "documents"), ~held_out("doc_id", 7, 2))
    return out.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(~held_out())
    out = score_toxicity(docs.withColumn("held_out", held_out()), fit(docs, labels))
    return out.select("doc_id", "held_out", "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = count_tokens(read_table(spark, sf_dir, "documents"), PIECE_BPE)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(read_table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_sha256("ids").alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations")).drop("key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_simhash_groups": op4_simhash_groups,
    "op5_sharding": op5_sharding,
    "op6_license_scan": op6_license_scan,
    "op7_lm_scores": op7_lm_scores,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_neighbours": op10_neighbours,
    "op11_whitening": op11_whitening,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversation_trie": op13_conversation_trie,
}



def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {name: shipped(query) for name, query in (QUERIES | {"pipeline": pipeline}).items()}
ORACLE: dict[str, str] = {"op13_conversation_trie": CONVERSATION_TRIE}
