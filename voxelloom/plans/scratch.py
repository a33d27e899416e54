"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session; where none is named, a folder of this machine, which only a local session can share."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="voxelloom-")
        spark.conf.set(_SETTING, named)
    return named.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/voxelloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again: what came from them must be written itself."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/voxelloom-" in path:
                spark = df.sparkSession
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
