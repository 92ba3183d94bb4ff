"""Connected components of a table of links, by the smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import HOT_KEYS, join_hot, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): label is the smallest node reachable.

    Each round every node takes the least label among its own and its neighbours', then the label of
    its label; rounds end when nothing changes. Nothing is collected but counts and whether a row changed.
    Nodes that hold more than a thousandth of all links, and labels of more than a thousandth of all nodes,
    are joined by broadcast: fewer than a thousand of either.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    n_links, n_nodes = both.count(), labels.count()
    hubs = both.groupBy("b").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") * HOT_KEYS > n_links).select("b")
    hubs = written(hubs, "hubs")
    while True:
        of_b = labels.withColumnRenamed("node", "b")
        near = join_hot(both, of_b, of_b.join(F.broadcast(hubs), "b", "left_semi"), ["b"], "a").groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        new = written(new, "near")
        large = new.groupBy("label").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") * HOT_KEYS > n_nodes).select("label")
        of_label = new.select(F.col("label").alias("of"), F.col("node").alias("label"))  # every label is a node
        jumped = join_hot(new, of_label, of_label.join(F.broadcast(large), "label", "left_semi"), ["label"], "node").select("node", "old", F.least("label", "of").alias("label"))
        labels = written(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
