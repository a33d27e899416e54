"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def labelled(docs: DataFrame, ratings: DataFrame, column: str, merge: str, learn: Column) -> DataFrame:
    """(doc_id, y, bytes): the label of each document that `learn` lets through, and the size of its text.

    Several labels of an id become one by the aggregate `merge`. Of several rows of an id the least text counts.
    """
    known = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y")).filter("doc_id is not null and y is not null").filter(learn).groupBy("doc_id").agg(F.expr(f"{merge}(y)").alias("y"))
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).groupBy("doc_id").agg(F.max("bytes").alias("bytes"))
    return known.join(sizes, "doc_id")


def bounded(docs: DataFrame, picked: DataFrame, most_bytes: int) -> DataFrame:
    """(doc_id, text, y), a row an id, of `picked` (doc_id, y, bytes), which has a bounded number of rows: in hash order, as many
    as have `most_bytes` of text. Texts of over a hundredth of that come last, so that one can't keep the others out."""
    before = Window.orderBy(F.col("bytes") * 100 > most_bytes, F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    few = picked.withColumn("upto", F.sum("bytes").over(before)).filter(F.col("upto") <= most_bytes).select("doc_id", "y")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")
