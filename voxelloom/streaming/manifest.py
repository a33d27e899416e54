"""Streaming: a growing folder of planes, and windowed counts. The array pipeline itself has no streams; these extend it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_planes(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Planes as they arrive in a folder of Parquet files."""
    return spark.readStream.schema(schema).parquet(folder)


def process_new(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, manifest: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Each batch's planes that no earlier batch listed are transformed, written and listed. A replayed batch finds the same
    planes and writes them over what it wrote before: both folders hold one part for each run (its checkpoint) and epoch."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        part = f"run={run}/epoch={epoch}"
        spark.createDataFrame([], df.select(*keys).schema).write.mode("overwrite").parquet(f"{manifest}/run=none/epoch=-1")
        listed = spark.read.parquet(manifest).filter((F.col("run") != run) | (F.col("epoch") < epoch)).select(*keys)
        fresh = df.dropDuplicates(keys).join(listed, keys, "left_anti").persist()
        transform(fresh).write.mode("overwrite").parquet(f"{out}/{part}")
        fresh.select(*keys).write.mode("overwrite").parquet(f"{manifest}/{part}")
        fresh.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by kind in tumbling windows; later ones than the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
