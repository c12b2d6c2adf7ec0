"""Connected components of a link table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_tasks, materialize


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) of every node of ``edges(a, b)``; the label is the component's smallest node.

    Every round a node takes the smallest label among its neighbours and itself, and then
    the label of that label, so long chains shorten by half.  Each round's labels are
    written out, so a lost executor never repeats earlier rounds.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a")).distinct()
    n = edges.count()
    both = materialize(in_tasks(both, 2 * n, 100_000), "links")
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label"))
    labels = materialize(in_tasks(labels, 2 * n, 100_000), "labels")
    for _ in range(rounds):
        seen = both.join(labels.withColumnsRenamed({"node": "other", "label": "l"}), "other").groupBy("node").agg(F.min("l").alias("l"))
        near = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = near.join(hop, "label", "left").select(
            "node", "old", F.least(F.col("label"), F.coalesce("next", "label")).alias("label"))
        new = materialize(in_tasks(new, 2 * n, 100_000), "labels")
        labels = new.select("node", "label")
        if not new.filter("label <> old").limit(1).count():
            return labels
    raise RuntimeError(f"the components did not settle in {rounds} rounds")
