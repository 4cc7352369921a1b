"""Connected components of a link table by hooking and pointer jumping.

Input: links (a, b) between nodes and a label per node (what the smallest
counts for, for instance the smallest document id of a class). Every round
joins the links with the labels, takes the smallest label next to each node
(combined inside the map tasks, so a hub costs one row per task) and then
jumps: a node takes the label that its label's own node holds. Rounds go on
until none changes; every round is written to the shared folder. Nothing is
collected; node labels must be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import written


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``links`` (a, b) and ``nodes`` (node, label) -> (node, component) of all linked nodes.

    ``component`` is the smallest label that the node reaches, its own
    included. Nodes without links are not returned.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    own = both.select(F.col("a").alias("node")).distinct().join(nodes, "node")
    # home: the node's own label; label: the smallest seen so far.
    state = written(own.select("node", F.col("label").alias("home"), "label"), "labels")
    while True:
        near = (both.join(state.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = state.join(near, "node").select("node", "home", F.col("label").alias("old"),
                                                 F.least("label", "near").alias("label"))
        hooked = written(hooked, "hooked")
        jump = hooked.select(F.col("home").alias("label"), F.col("label").alias("far"))
        moved = written(hooked.join(jump, "label", "left").select(
            "node", "home", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        state = moved.select("node", "home", "label")
        if moved.filter("label <> old").isEmpty():
            return state.select("node", F.col("label").alias("component"))
