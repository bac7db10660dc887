"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: dict[int, int]) -> DataFrame:
    """doc_id, text, ``label`` and weight of at most ``rows[v]`` labelled documents of each label v.

    Weights restore the labels' shares that the bounds change.

    The documents are the first by a hash of doc_id, chosen among the labels
    alone; only their ids (a bounded number) are broadcast to the texts. Of
    several labels of a document the largest counts; null labels and texts are left out.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(label).cast("int").alias(label)))
    there = {r[label]: r["count"] for r in known.where(F.col(label).isin(*rows)).groupBy(label).count().collect()}
    parts = [known.where(F.col(label) == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             .withColumn("weight", F.lit(max(1.0, there.get(v, 0) / n))) for v, n in rows.items()]
    chosen = reduce(DataFrame.unionAll, parts)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(
        F.broadcast(chosen), "doc_id")
