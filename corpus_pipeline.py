"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of its predecessor, whose result is
written and read again in between. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelattice.llm import decontaminate, minhash, packing, passages, quality
from hirelattice.llm.common import read_table, ready, stored, unused
from hirelattice.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network scores at 0.5 or more. It is fitted on labelled rows of ``docs``."""
    ready(spark)
    score = quality.scorer(quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) >= 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lowest document of every group of near copies; documents without an id or words stay."""
    ready(spark)
    name = unused(docs, "_gone")
    gone = stored(minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias(name)).distinct(), "copies")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each repeated passage left in the lowest one that has it."""
    ready(spark)
    return passages.remove_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ready(spark)
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 1024, as ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``."""
    ready(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end=0)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_of_each),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

# a fitted network, MinHash groups and a tokenizer's ids are beyond SQL; tests/llm holds each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(ready(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k}")
    return docs
