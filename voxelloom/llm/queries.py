"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, mixing, near_dedup, oracles, pseudonyms, quality, quality_rules, secrets, token_counts, toxicity
from .storage import table

#: Public vocabulary file; a path on the driver.
VOCABULARY = os.environ.get("VOXELLOOM_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")
#: A deployment passes its own secret.
PSEUDONYM_KEY = "voxelloom public test key"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out())
    rated = quality.rate(docs, model)
    return rated.select("doc_id", quality.held_out().alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= 0.5).alias("kept"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs, ~language.held_out()))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", F.size("shares").alias("n_langs"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score(docs, weights)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.load_vocabulary(VOCABULARY))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality, op2_language, op3_minhash, op4_toxicity, op5_pseudonyms, op6_token_counts, op7_secrets, op8_decontaminate, op9_quality_rules, op10_mixing,
)}
ORACLES: dict[str, str] = {"op3_minhash": oracles.NEAR_DEDUP, "op8_decontaminate": oracles.DECONTAMINATE, "op9_quality_rules": oracles.QUALITY_RULES}
