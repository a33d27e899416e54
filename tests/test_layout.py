from __future__ import annotations

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_training_data_part():
    for path in (ROOT / "voxelloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"(from|import)\s+[\w.]*\bllm\b", path.read_text()), path


def test_entry_has_matching_names():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_no_local_checkpoints_or_rdds():
    for path in (ROOT / "voxelloom").rglob("*.py"):
        assert not re.search(r"localCheckpoint|\.rdd\b|mapPartitions\(", path.read_text()), path


def test_plans_push_filters_and_prune_columns(spark, tmp_path):
    from voxelloom.sources.readers import crop

    spark.range(100).selectExpr("cast(id as int) z", "0 y", "0 x", "1 v", "0 channel", "0 res", "'unused' note").write.parquet(str(tmp_path / "v"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = crop(spark.read.parquet(str(tmp_path / "v")), (10, 0, 0), (5, 0, 0), 0, 0).select("z", "v")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(z,10)" in plan and "note" not in plan


def test_box_joins_are_equi_joins(spark):
    from pyspark.sql import functions as F

    from voxelloom.operators.spatial import overlap_join

    b = spark.range(1000).select(*(F.col("id").cast("int").alias(f"{p}{c}{k}") if k == 0 else (F.col("id") + 5).cast("int").alias(f"{p}{c}{k}") for p in ("a_",) for c in "xyz" for k in (0, 1)))
    o = b.select(*(F.col(c).alias(c.replace("a_", "b_")) for c in b.columns))
    plan = overlap_join(b, o, "a_", "b_", 16)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
