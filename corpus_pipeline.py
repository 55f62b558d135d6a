"""The corpus pipeline: documents in, token ids out.

Each stage is one operator of ``barflow.llm``; ``run`` writes its result as
Parquet in the shared scratch folder and rereads it as the next stage's input.
Stages keep the columns of documents, but for the last, which returns doc_id,
n_chars, n_tokens, token_ids and round_trip, one row for each copy in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import kneser_tables, mixing, secret_scan, simhash_pivots, suffix_pieces
from barflow.llm.common import Scratch, read, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = kneser_tables.train(docs, read(spark, sf_dir, "labels"))
    score, = unused(docs, "_score")
    return (kneser_tables.scored(docs, model, score)
            .where(F.col(score) < 0.5).drop(score))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints: the one with the smallest id."""
    return simhash_pivots.keep_first(docs, radius=2, shingle=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by a mark; every document stays."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated, none more than twice; every document stays at least once."""
    return mixing.mixed(docs, max_epochs=2.0)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", to_tokens),
]

# Trained models and a tokenizer decide the rows: SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir), docs)     # the stage before is read no more
    return docs
