"""The corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, documents that hold benchmark items go, sources are mixed to
target weights, and what is left is written as token ids and read back.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each
stage's rows as Parquet into the shared folder and rereads them for the next.
As a stage's input is written, what earlier stages staged for themselves is
deleted when a stage begins. All but the last keep the columns of ``documents``. Stages work on whatever
their predecessor kept; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontaminate, minhash_tensor, mixing, token_orc, toxicity
from cohortlens.llm.common import read, release, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of toxicity.THRESHOLD or more go; null
    and empty texts score 0 and stay. The model learns from labelled documents
    that are not held out."""
    release(spark)
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), toxicity.not_held_out)
    return toxicity.without_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    release(spark)
    return minhash_tensor.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    release(spark)
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row for each copy."""
    release(spark)
    return mixing.emitted(mixing.mix(docs, mixing.words("text")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 from the token files, a row for each row of ``docs``."""
    release(spark)
    return token_orc.encode_and_reread(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("decontamination", decontaminated), ("mixing", mixed), ("token_output", tokens)]

#: SQL can express neither the trained models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name, keep=True)
    return docs
