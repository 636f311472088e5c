"""Reconciliation beside the high-water mark: hash trees of row digests by key range.

A mark finds rows by their stamps. A row that arrives late with an old stamp, or is changed
without a new one, is never seen by it. Here both sides get a tree of digests: the leaves
sum up the digests of the rows of a range of keys, each level above joins ``FAN`` ranges. The
trees are compared from the top; only children of ranges that differ are looked at, and
rows are read, and compared one by one, only in the leaves that are left. The tree of a
table that has not changed is a small table that can be kept and read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.tables import Warehouse

#: keys of a leaf's range, children of a node and levels above the leaves, as powers of two
LEAF_BITS, FAN_BITS = 8, 4


def row_digest(columns: list[str]):
    """64-bit digest of a row's columns, nulls told from values."""
    parts = []
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


@dataclass
class HashTree:
    """(level, node, n, digest, mixed): rows, xor of digests and xor of mixed digests of a node.

    Two sums are kept, so that two equal rows do not cancel each other out unseen: the
    count tells them. Null keys are node -1 of each level, beside the others."""

    nodes: DataFrame
    levels: int
    leaf_bits: int


def build(df: DataFrame, key: str, columns: list[str], levels: int = 3, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """The nodes of all levels (0: leaves) of ``df``, one aggregate and a pass over its result.

    Keys are integers. A hot range is summed up on the map side, so it is one row a task."""
    digest = row_digest(columns)
    nothing = F.lit(None).cast("long")
    leaf = df.select(F.shiftright(F.col(key).cast("long"), leaf_bits).alias("node"), digest.alias("d")).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("d").alias("digest"), F.bit_xor(F.xxhash64("d")).alias("mixed"))
    up = leaf.select(F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"), "node", "n", "digest", "mixed")
    shift = F.call_function("shiftright", F.col("node"), F.col("level") * FAN_BITS)
    return up.withColumn("node", F.when(F.col("node").isNull(), nothing).otherwise(shift)).groupBy("level", "node").agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("mixed").alias("mixed"))


def differing_leaves(left: DataFrame, right: DataFrame, levels: int) -> DataFrame:
    """(node): leaves that differ, found from the top level down.

    ``left`` and ``right`` are written trees, partitioned by level. A level's differing nodes
    are the only ones whose children the next level compares, and only they are shuffled."""
    def at(tree: DataFrame, level: int) -> DataFrame:
        return tree.filter(F.col("level") == level).select("node", "n", "digest", "mixed")

    parents = None
    for level in range(levels, -1, -1):
        sides = [at(t, level) for t in (left, right)]
        if parents is not None:
            up = [s.withColumn("parent", F.shiftright("node", FAN_BITS)) for s in sides]
            sides = [u.join(parents, u["parent"].eqNullSafe(parents["up"]), "left_semi").drop("parent") for u in up]
        a, b = sides[0], sides[1].select(*[F.col(c).alias(f"r_{c}") for c in ("node", "n", "digest", "mixed")])
        both = a.join(b, a["node"].eqNullSafe(b["r_node"]) & F.lit(True), "full_outer")
        same = F.col("n").eqNullSafe(F.col("r_n")) & F.col("digest").eqNullSafe(F.col("r_digest")) & F.col("mixed").eqNullSafe(F.col("r_mixed"))
        parents = both.filter(~same).select(F.when(F.col("n").isNull(), F.col("r_node")).otherwise(F.col("node")).alias("up"))
    return parents.withColumnRenamed("up", "node")


def reconcile(wh: Warehouse, source: DataFrame, target: DataFrame, key: str, columns: list[str], name: str, levels: int = 3,
              leaf_bits: int = LEAF_BITS) -> DataFrame:
    """(key, finding) of all rows that differ: ``missing in target``, ``missing in source`` or ``different``.

    The trees are written as ``<name>_source_tree`` and ``<name>_target_tree``. Rows of a key
    that is there several times are compared as a set: the key is ``different`` if the sets
    are. Rows with a null key are one range of their own, and one key.
    """
    trees = [wh.save(build(df, key, columns, levels, leaf_bits), "silver", f"{name}_{side}_tree", partition_by=["level"])
             for side, df in (("source", source), ("target", target))]
    leaves = wh.save(differing_leaves(*trees, levels), "silver", f"{name}_leaves")
    low, high, n = leaves.agg(F.min("node"), F.max("node"), F.count(F.lit(1))).first()
    no_key = leaves.filter(F.col("node").isNull()).limit(1).count() > 0

    def rows(df: DataFrame) -> DataFrame:
        """Rows of the differing ranges: the span of all is pushed down to the scan."""
        inside = F.col(key).between(F.lit((low or 0) << leaf_bits), F.lit((((high or 0) + 1) << leaf_bits) - 1)) if low is not None else F.lit(False)
        near = df.filter((inside | F.col(key).isNull()) if no_key else inside)
        near = near.withColumn("_node", F.shiftright(F.col(key).cast("long"), leaf_bits))
        met = near.join(leaves, near["_node"].eqNullSafe(leaves["node"]), "left_semi")
        return met.select(F.col(key), row_digest(columns).alias("d")).groupBy(key).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor("d").alias("digest"), F.bit_xor(F.xxhash64("d")).alias("mixed"))

    a = rows(source)
    b = rows(target).select(F.col(key).alias("r_key"), F.col("n").alias("r_n"), F.col("digest").alias("r_digest"), F.col("mixed").alias("r_mixed"))
    both = a.join(b, a[key].eqNullSafe(b["r_key"]) & F.lit(True), "full_outer")
    finding = F.when(F.col("r_n").isNull(), "missing in target").when(F.col("n").isNull(), "missing in source").when(
        (F.col("n") != F.col("r_n")) | (F.col("digest") != F.col("r_digest")) | (F.col("mixed") != F.col("r_mixed")), "different")
    return both.select(F.when(F.col("n").isNull(), F.col("r_key")).otherwise(F.col(key)).alias(key), finding.alias("finding")).filter("finding IS NOT NULL")
