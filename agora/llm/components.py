"""Connected components of a link table, by hooking and pointer jumping on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.session import materialize, materialize_counted


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b long): the smallest node that it reaches.

    Every round hooks each remaining root on its smallest neighbour, flattens the hooks by pointer jumping and renames
    the links; the links that remain join different roots and run out after a logarithmic number of rounds. The work
    is joins and minima per node, with partial minima before each shuffle, so a hub is no bottleneck.

    Defined cases: a link of a node with itself and repeated links count for nothing, and a node without another link has
    no row; an empty table has none. Ends that are null link nothing.
    """
    links = links.where("a <> b").distinct()
    labels = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
        parents = materialize(least.select("node", F.least("node", "other").alias("parent")), "parents")
        while True:
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            raised = parents.join(up, "parent").select("node", "parent", "top")
            raised, seen = materialize_counted(raised, "raised", moved=F.count_if(F.col("parent") != F.col("top")))
            parents = raised.select("node", F.col("top").alias("parent"))
            if not seen["moved"]:
                break
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            step = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(step, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
            labels = materialize(labels, "labels")
        left = links.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("ra")), "a")
        left = left.join(parents.select(F.col("node").alias("b"), F.col("parent").alias("rb")), "b")
        left = left.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        links, seen = materialize_counted(left, "links", n=F.count(F.lit(1)))
        if not seen["n"]:
            return labels
