"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, root) whose roots are their own: each chain is halved until none is left."""
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = written(parents.join(above, "root").select("node", F.col("root").alias("before"), F.col("further").alias("root")), "roots")
        parents = jumped.select("node", "root")
        if not jumped.where("root <> before").limit(1).count():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component.

    ``edges`` has (a, b) of type bigint; nodes without an edge do not occur. In each round
    every node hooks on to its least neighbour, if that is smaller; the trees that this
    makes become one node each, their root, and only edges between different roots go on.
    So the edge table shrinks from round to round and is never joined whole again. A
    round's tables are written to the shared folder, which ends their lineage; the driver
    sees only whether edges are left. The smallest node of a component is always a root.
    Nodes with very many edges are summed up before the shuffle, and their side of the
    join is split by AQE.
    """
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or left.limit(1).count():
        ends = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        rounds.append(_roots(written(hooked, "hooked")))
        low, high = (rounds[-1].select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        between = left.join(low, "a").join(high, "b").where("root_a <> root_b")
        left = written(between.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "edges")
    labels = rounds.pop().select("node", F.col("root").alias("label"))
    while rounds:  # a root that later rounds do not have is its component's smallest node
        later = labels.select(F.col("node").alias("root"), "label")
        labels = rounds.pop().join(later, "root", "left").select("node", F.coalesce("label", "root").alias("label"))
    return written(labels, "labels")
