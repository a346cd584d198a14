"""Connected components of a link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.runtime import drop_scratch, materialize


def _hooked(both: DataFrame) -> DataFrame:
    """(node, root): the smallest among a node and its neighbours."""
    return (both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least"))
            .select("node", F.least("node", "least").alias("root")))


def _spread(both: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) of every node of a symmetric graph, and the folder that holds it.

    Each round a node takes the smallest label among itself and its neighbours,
    then the label of that label, so labels travel in growing steps.
    """
    spark = both.sparkSession
    labels, at = materialize(_hooked(both), "labels")
    while True:
        near = both.join(labels, both.src == labels.node).groupBy("dst").agg(F.min("root").alias("near"))
        step = labels.join(near, labels.node == near.dst, "left").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        via = labels.select(F.col("node").alias("via"), F.col("root").alias("next"))
        moved = step.join(via, step.low == via.via, "left").select("node", "old", F.least("low", "next").alias("root"))
        moved, new = materialize(moved, "labels")
        drop_scratch(spark, at)
        labels, at = moved.select("node", "root"), new
        if not moved.where("root <> old").limit(1).count():
            return labels, at


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node reachable.

    The graph is first drawn anew between every node's smallest neighbours, of
    which a large group has few, and labels are spread over what is left. Every
    table is written to the shared folder, which cuts its lineage; only whether
    a label changed reaches the driver. Links may repeat and may be given in one
    direction. No links: no rows.
    """
    spark = edges.sparkSession
    both, both_at = materialize(
        edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
        .union(edges.select(F.col(b).alias("src"), F.col(a).alias("dst"))).where("src <> dst").distinct(), "edges")
    hooks, hooks_at = materialize(_hooked(both), "hooks")
    ends = hooks.select(F.col("node").alias("via"), F.col("root").alias("end"))
    one = both.join(ends, both.src == ends.via).select(F.col("end").alias("from"), "dst")
    two = one.join(ends, one.dst == ends.via).select(F.col("from").alias("src"), F.col("end").alias("dst"))
    few, few_at = materialize(two.where("src <> dst").distinct(), "edges")
    drop_scratch(spark, both_at)
    labels, labels_at = _spread(few)
    last = labels.select(F.col("node").alias("via"), F.col("root").alias("end"))
    out, _ = materialize(hooks.join(last, hooks.root == last.via, "left").select("node", F.coalesce("end", "root").alias("root")),
                         "roots")
    drop_scratch(spark, hooks_at, few_at, labels_at)
    return out
