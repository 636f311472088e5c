"""Sharding on a consistent-hash ring with virtual nodes and bounded loads (operator 9).

Every shard owns ``vnodes`` points of the ring; a key belongs to the next point
clockwise of its hash. Each shard holds an exact share of the rows (shares differ by
one at most). A shard keeps its own keys up to its share; what overflows goes on
clockwise to the next shard with room. Only the overflow leaves its home shard.

Spark counts the keys of each arc; the flow of overflow between arcs is worked out on
those counts (``shards * vnodes`` numbers, whatever the input); rows then find their
shard by their rank inside their arc. Ranks come from a range partitioning whose sort
key ends in a row number, so one key with a third of all rows spreads over many tasks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written


@dataclass(frozen=True)
class Ring:
    """Points of the ring in order, and the shard that owns each."""

    points: np.ndarray
    owners: np.ndarray
    shards: int

    @classmethod
    def build(cls, shards: int, vnodes: int) -> Ring:
        at = {}
        for s in range(shards):
            for v in range(vnodes):
                at[int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True)] = s
        points = np.array(sorted(at), dtype=np.int64)
        return cls(points, np.array([at[int(p)] for p in points]), shards)

    def arc(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the first point at or after each hash, around the end to 0."""
        return np.searchsorted(self.points, hashes) % len(self.points)


def flow(ring: Ring, counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(arc, from rank, to rank, shard, first slot): where each arc's keys go.

    ``counts`` has the keys of each arc. Shards hold equal shares, the first ones a
    row more. Own keys go first; then each arc's overflow walks clockwise.
    """
    total, shards = int(counts.sum()), ring.shards
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    filled = np.zeros(shards, dtype=np.int64)
    out, over = [], []

    def put(arc: int, lo: int, n: int, shard: int) -> None:
        out.append((int(arc), int(lo), int(lo + n), int(shard), int(filled[shard])))
        filled[shard] += n
        room[shard] -= n

    for arc in np.flatnonzero(counts):
        shard = ring.owners[arc]
        n = min(int(counts[arc]), int(room[shard]))
        if n:
            put(arc, 0, n, shard)
        if n < counts[arc]:
            over.append((arc, n))
    for arc, done in over:
        step = arc
        while done < counts[arc]:
            step = (step + 1) % len(ring.owners)
            shard = ring.owners[step]
            n = min(int(counts[arc]) - done, int(room[shard]))
            if n:
                put(arc, done, n, shard)
                done += n
    return out


def assign(docs: DataFrame, shards: int = 16, vnodes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, home_shard), a row per document.

    The law is ``rows``: shard counts are at most one apart. ``size`` is the text's
    UTF-8 bytes plus 1, a null text has none; its checksum is that of no bytes. A null
    id is a key like any other. Rows with equal ids share a home shard and are told
    apart by their rank, in order of size, checksum and row number; repeated rows are
    all kept. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ring = Ring.build(shards, vnodes)
    text = F.coalesce(docs[text_col], F.lit(""))
    keyed = written(
        docs.select(
            docs[id_col].alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(docs[id_col]).alias("pos"),
        ),
        "ring-keys",
    )

    @F.pandas_udf("int")
    def arc_of(pos: pd.Series) -> pd.Series:
        return pd.Series(ring.arc(pos.to_numpy()).astype(np.int32))

    order = ["arc", "pos", "id", "size", "text_crc32", "row"]
    dealt = written(
        keyed.withColumn("arc", arc_of("pos"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id()),
        "ring-dealt",
    )
    # at most one row for each arc and for each border between partitions
    local = dealt.groupBy("part", "arc").agg(F.count(F.lit(1)).alias("n")).orderBy("arc", "part").collect()
    counts = np.zeros(len(ring.points), dtype=np.int64)
    before = []
    for r in local:
        before.append((r["part"], r["arc"], int(counts[r["arc"]])))
        counts[r["arc"]] += r["n"]
    plan = spark.createDataFrame(flow(ring, counts), "arc int, lo bigint, hi bigint, shard int, base bigint")
    bases = spark.createDataFrame(before, "part int, arc int, before bigint")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(Window.partitionBy("part", "arc").orderBy(*order)))
        .join(F.broadcast(bases), ["part", "arc"])
        .withColumn("rank", F.col("before") + F.col("nth") - 1)
    )
    homes = F.element_at(F.array(*[F.lit(int(o)) for o in ring.owners]), F.col("arc") + 1)
    return (
        ranked.join(F.broadcast(plan), "arc")
        .where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            homes.alias("home_shard"),
        )
    )
