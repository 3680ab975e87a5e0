"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node it reaches), for every node of ``links(a, b)``.

    Each round gives a node the least label among its neighbours' and then follows that label
    once (label := label of label), so long chains halve.  Rounds go on until no label
    changes; labels stay in tables, the driver sees one count per round.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = materialise(both, "links", few=True)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label"))
    labels = materialise(labels, "labels", few=True)
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "low").alias("new"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("t_label"))
        moved = hooked.join(target, hooked["new"] == target["t"]).select("node", F.col("label").alias("old"), F.least("new", "t_label").alias("label"))
        moved = materialise(moved, "labels", few=True)
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")
