"""Tables in and between operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.scratch import discard, shared_dir, written

__all__ = ["discard", "shared_dir", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
