"""A corpus pipeline: each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxelloom.llm import decontaminate, mixing, near_dedup, secrets, toxicity
from voxelloom.llm.storage import table, written
from voxelloom.plans.deploy import ship

#: A pair at similarity 0.8 misses all 25 bands of 5 with probability 5e-5; the slack is five standard errors at 0.8.
NEAR_COPIES = near_dedup.Plan(percent=80, bands=25, rows=5, slack=0.22)
#: Each source meets its target to within half of one document; no text is cut.
WHOLE = mixing.Recipe(whole_documents=True)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    ship(spark)
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.drop_toxic(docs, weights)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, also where rows share a doc_id."""
    ship(spark)
    return near_dedup.drop_near_duplicates(docs, NEAR_COPIES, once=False)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    ship(spark)
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each draw of a whole document, with its shard and place."""
    ship(spark)
    return mixing.mixed(docs, WHOLE)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: No SQL: a learned model and MinHash candidates; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
