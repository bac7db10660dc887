"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FILE_ROWS = 250_000


def components(links: DataFrame) -> DataFrame:
    """``links``: node_a, node_b (long). Returns node, label: the smallest node reachable.

    Each round takes the least label among a node's neighbours, then the label
    of that label, until nothing changes. Labels are written to the shared
    folder after each round, so plans stay short and lost executors cost a read.
    Nodes without links do not appear; no links: no rows. Files of ``FILE_ROWS`` links each: tables of few links are few files.
    """
    files = 1 + links.count() // FILE_ROWS
    both = materialize(links.select("node_a", "node_b")
                       .union(links.select(F.col("node_b").alias("node_a"), F.col("node_a").alias("node_b")))
                       .where("node_a <> node_b").distinct(), files=files)
    labels = materialize(both.groupBy(F.col("node_a").alias("node"))
                         .agg(F.min("node_b").alias("near"))
                         .select("node", F.least("node", "near").alias("label")), files=files)
    while True:
        near = (both.join(labels.select(F.col("node").alias("node_b"), "label"), "node_b")
                .groupBy(F.col("node_a").alias("node")).agg(F.min("label").alias("near")))
        stepped = (labels.join(near, "node")
                   .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = materialize(stepped.join(jump, "label")
                            .select("node", "old", F.least("label", "far").alias("label")), files=files)
        if after.where("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
