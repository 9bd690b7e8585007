"""Connected components over an edge table, by rounds of least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), of any sortable type, to (node, component): the least node that
    links reach.  Only nodes with an edge appear.

    A label is a node of the same component, so it has a label itself, the grand label.
    In a round each node takes the least of its own and its neighbours' grand labels, and
    hands its neighbours' on to its label, as one aggregate; thus ways are halved and
    rounds grow with the logarithm of the longest way, until no label changes.  Labels are
    stored after each round; hubs are summed by partial aggregates, and the joins on them
    can be split, since no step needs a hub's neighbours in one place."""
    both = store(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("grand"))
        grands = store(labels.join(parents, "label").select("node", "label", "grand"), "grands")
        sent = both.join(grands.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("m"))
        met = store(grands.join(sent, "node").select("node", "label", F.least("grand", "m").alias("m")), "met")
        none = F.lit(None).cast(labels.schema["label"].dataType)
        own = met.select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        handed = met.where("m < label").select(F.col("label").alias("node"), F.col("m").alias("label"), none.alias("old"))
        new = store(own.union(handed).groupBy("node").agg(F.min("label").alias("label"), F.min("old").alias("old")), "labels")
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
