"""The registered queries of the operators: ``opN_<name>`` applies operator N to its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import (kneser_tables, minhash_stars, mixing, periodic_runs, pii_boost, pruned_graph,
                         secret_scan, simhash_blocks, simhash_pivots, suffix_pieces, turn_repair, url_boost, zstd_language)
from barflow.llm.common import fold, kind_count, listed_spans, read


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (simhash_pivots.near_duplicates(docs, radius=2, shingle=3)
            .select("doc_id", "fingerprint", "component_id"))


def op2_url_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_boost.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op3_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_blocks.fingerprints(read(spark, sf_dir, "documents"))


def op4_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned_graph.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def digest(found: DataFrame, base: Column, every: Column, kinds: tuple[str, ...], counted: tuple[str, ...],
           *more: Column) -> DataFrame:
    return found.select(
        "doc_id", *[kind_count(base, k).alias(f"n_{k}") for k in counted], *more,
        F.sha2(listed_spans(base, kinds), 256).alias("base_sha256"),
        listed_spans(every, kinds).alias("spans"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_spans(docs, "found").select("doc_id", "found.base", "found.added")
    return digest(found, F.col("base"), F.concat("base", "added"), secret_scan.KINDS,
                  ("assign", "access", "hex"), F.size("added").cast("long").alias("n_random"))


def op6_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = zstd_language.identify(F.col("text"), zstd_language.learn(docs))
    return (docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), judged.alias("j"))
            .select("doc_id", "held_out", F.col("j.lang").alias("lang_pred"), "j.score", "j.rejected"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.realise(docs, max_epochs=2.0).select(
        "doc_id", "source", "tokens", "weight", "epoch", "block", "slot")


def op8_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_pieces.encode(read(spark, sf_dir, "documents"))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_tables.train(docs, read(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))      # a null id is in no fold
    scored = kneser_tables.scored(docs, model, "score", "log_ratio").select(
        "doc_id", held_out.alias("held_out"), "score", "log_ratio")
    return scored.select("doc_id", "held_out", "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "log_ratio")


def op10_pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trees = pii_boost.fit(docs)
    found = docs.select("doc_id", pii_boost.find_spans(F.col("text"), trees).alias("every"))
    found = found.withColumn("base", F.filter("every", lambda s: s["kind"].isin(*pii_boost.KINDS)))
    return digest(found, F.col("base"), F.col("every"), (*pii_boost.KINDS, *pii_boost.LIKE),
                  pii_boost.KINDS)


def op11_minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_stars.near_duplicates(read(spark, sf_dir, "documents"), percent=85, shingle=5)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, there = turn_repair.damaged(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return turn_repair.Repair(rows, there).digests()


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = periodic_runs.planted(F.col("text"), F.col("doc_id"))
    found = docs.select("doc_id", text.alias("text")).select(
        "doc_id", periodic_runs.words_joined(F.col("text")).alias("words"),
        periodic_runs.find_runs(F.col("text")).alias("f"))
    found = found.select("doc_id", "words", "f.runs", "f.collapsed",
                         periodic_runs.strongest(F.col("f.runs")).alias("best"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", "words"), 256).alias("collapsed_sha256"))


SPARK_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_pivots, op2_url_boost, op3_simhash_blocks, op4_pruned_graph, op5_secret_scan,
        op6_zstd_language, op7_mixing, op8_suffix_pieces, op9_kneser_ney, op10_pii_boost,
        op11_minhash_stars, op12_turn_repair, op13_periodic_runs)
}

# Fingerprint groups, trained models, graphs and tokenizers decide the other
# queries' rows; they are tested against brute force and held-out rows instead.
ORACLE_SQL: dict[str, str] = {}
