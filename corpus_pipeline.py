"""Corpus pipeline: toxicity, language, near-duplicates, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents`` and only drop rows; the last returns the packed pieces.  Empty inputs pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscope.llm.common import cut, shipped
from logscope.llm.decontamination import drop_contaminated
from logscope.llm.language import identify, train_text
from logscope.llm.packing import pack_documents
from logscope.llm.queries import SHINGLE_WORDS, SIMHASH_BITS, WORD_BPE
from logscope.llm.simhash import keep_one
from logscope.llm.toxicity import fit, held_out, score_toxicity
from logscope.sources import read_table

PACK_MEMO_BYTES = 64 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, does not predict toxic."""
    model = fit(docs, read_table(spark, sf_dir, "labels").filter(~held_out()))
    return score_toxicity(docs, model).filter("predicted = 0").select(*docs.columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, with ``lang`` as declared language and ``source`` as host."""
    out = identify(docs, train_text(docs), "text", declared="lang", host="source")
    return out.filter("accepted").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return keep_one(docs, words=SHINGLE_WORDS, max_bits=SIMHASH_BITS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their sequences and offsets; the Python workers, which keep their memory,
    serve the other stages as well, so the memo is smaller than op1's."""
    return pack_documents(docs, WORD_BPE, memo_bytes=PACK_MEMO_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]
STAGES = [(name, shipped(stage)) for name, stage in STAGES]

#: A trained model, language posteriors and hash chains are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared checkpoint folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
