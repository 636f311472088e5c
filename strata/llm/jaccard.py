"""Jaccard join on word n-grams by a MinHash LSH forest (operator 8).

Documents are sets of five-word shingles. Equal sets are one set with a weight. Each
set has a path of MinHash values in every tree of the forest. The paths of a tree, sorted,
are its prefix trie: sets below one node stand next to each other. Spark sorts all paths by
range, so a crowded node is cut over tasks, and one pass compares each path with the next:
a set's prefix is shortened from the full path to what it shares with its neighbour, but
not below the depth at which a pair at the threshold meets in some tree with the target
recall. Neighbours that still match are tied; so are the last path of a task and the first
of the next.

No node lists its pairs: n sets below it have n - 1 ties, and the parts of the graph of
all ties are checked exactly: the shingle sets of a part are compared block
by block, each pair of blocks in a task of its own, so no link inside a part is missed
and a part of any size is dealt over many tasks. A block comparison returns the weight
of each set's links and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import enter, fold, trim, word_hashes, written
from strata.llm.graph import components


@dataclass(frozen=True)
class Params:
    words: int = 5
    threshold: float = 0.8
    trees: int = 24
    #: full length of a path
    depth: int = 12
    #: least probability that a pair at the threshold meets
    recall: float = 0.999
    #: sets of a block; two blocks are compared at once
    block: int = 1024

    @property
    def prefix(self) -> int:
        """The longest prefix that reaches the target recall."""
        n = self.depth
        while n > 1 and 1 - (1 - self.threshold**n) ** self.trees < self.recall:
            n -= 1
        return n


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a text with fewer words is one shingle."""
    hashes, at, _ = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(0, n - words + 1), dtype=np.uint64)
    for i in range(words):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - words + 1 + i] if len(rolled) else rolled
    rolled = fold(rolled)
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        if hi - lo >= words:
            out.append(np.unique(rolled[lo : hi - words + 1]))
        elif hi > lo:
            h = np.uint64(hi - lo)
            for w in hashes[lo:hi]:
                h = fold(np.array([h]) + w)[0]
            out.append(np.array([h], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def tree_paths(sets: list[np.ndarray], p: Params) -> np.ndarray:
    """(sets, trees, bytes) paths: the tree's number, then ``depth`` MinHash values of 16 bits,
    so that byte order is the tries' order; sets are not empty."""
    random = np.random.default_rng(8)
    mult = random.integers(1, 1 << 32, p.trees * p.depth, dtype=np.uint32) | np.uint32(1)
    add = random.integers(0, 1 << 32, p.trees * p.depth, dtype=np.uint32)
    out = np.zeros((len(sets), p.trees, 2 + 2 * p.depth), dtype=np.uint8)
    out[:, :, 0], out[:, :, 1] = np.arange(p.trees) >> 8, np.arange(p.trees) & 255
    values = out[:, :, 2:].reshape(len(sets), p.trees, p.depth, 2)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (size == 0 or size + len(sets[j]) <= 1 << 16):
            size += len(sets[j])
            j += 1
        x = (np.concatenate(sets[i:j]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in sets[i : j - 1])])
        h = np.empty_like(x)
        for k in range(p.trees * p.depth):
            np.multiply(x, mult[k], out=h)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h += add[k]
            # the least value is small: 16 bits of a mix of it
            least = fold(np.minimum.reduceat(h, starts))
            values[i:j, k // p.depth, k % p.depth, 0] = (least >> np.uint64(8)).astype(np.uint8)
            values[i:j, k // p.depth, k % p.depth, 1] = least.astype(np.uint8)
        i = j
    out[:, :, 2:] = values.reshape(len(sets), p.trees, 2 * p.depth)
    return out


def shared_depth(paths: np.ndarray) -> np.ndarray:
    """Of each path and the next: values that they share from the root on; -1 in another tree."""
    same = paths[1:] == paths[:-1]
    tree, pairs = same[:, :2].all(axis=1), same[:, 2:].reshape(len(same), (paths.shape[1] - 2) // 2, 2).all(axis=2)
    return np.where(tree, np.cumprod(pairs, axis=1).sum(axis=1), -1)


def trie_ties(members: DataFrame, p: Params) -> DataFrame:
    """(a, b, depth): neighbours in the sorted tries whose shared prefix reaches ``p.prefix``.

    ``members`` is a written table of (node, path). The driver sees nothing; the ends of the
    sorted ranges, two rows a task, are put together in one more sort.
    """
    width, least = 2 + 2 * p.depth, p.prefix

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard")
        before, ends = None, []
        shape = ["a", "b", "depth", "path"]

        def edge(node: int, path: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([path], pa.binary())], names=shape)

        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy()
            column = batch.column(1)
            raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)
            at = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset]
            paths = raw[at : at + width * batch.num_rows].reshape(batch.num_rows, width)
            if before is None:
                ends.append(edge(int(node[0]), paths[0].tobytes()))
            else:
                node, paths = np.concatenate((before[0], node)), np.concatenate((before[1], paths))
            depth = shared_depth(paths)
            tied = np.flatnonzero((depth >= least) & (node[1:] != node[:-1]))
            if len(tied):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[tied]), pa.array(node[tied + 1]), pa.array(depth[tied].astype(np.int32)), pa.nulls(len(tied), pa.binary())], names=shape)
            before = (node[-1:].copy(), paths[-1:].copy())
        if before is not None:
            yield from ends
            yield edge(int(before[0][0]), before[1].tobytes())

    dealt = members.repartitionByRange("path", "node").sortWithinPartitions("path", "node").select("node", "path")
    found = written(dealt.mapInArrow(compare, "a bigint, b bigint, depth int, path binary"), "jaccard-ties")
    inside = found.where("path IS NULL").select("a", "b", "depth")
    order = Window.orderBy("path", "a")
    seams = found.where("path IS NOT NULL").select("a", F.lead("a").over(order).alias("b"), "path", F.lead("path").over(order).alias("next"))
    head = lambda c: F.substring(c, 1, 2 + 2 * least)
    seams = seams.where((F.col("a") != F.col("b")) & (head("path") == head("next"))).select("a", "b", F.lit(least).alias("depth"))
    return inside.unionByName(seams)


def signatures(docs: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame:
    """(key, set_a, set_b, shingles, paths) of every document; without an id or a word the set is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard")
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                known = part.column(0).is_valid().to_pylist()
                sets = shingle_sets([t or "" for t in part.column(1).to_pylist()], p.words)
                have = [k for k, s in enumerate(sets) if len(s) and known[k]]
                rest = part.column(0).take(pa.array(sorted(set(range(len(sets))) - set(have)), pa.int64()))
                if len(rest):
                    nothing = pa.nulls(len(rest), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [rest, nothing, nothing, pa.array([0] * len(rest), pa.int32()), pa.nulls(len(rest), pa.binary())],
                        names=["key", "set_a", "set_b", "shingles", "paths"],
                    )
                if not have:
                    continue
                own = [sets[k] for k in have]
                starts = np.cumsum([0, *(len(s) for s in own[:-1])])
                flat = np.concatenate(own)
                paths = tree_paths(own, p)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(have)),
                        pa.array(fold(np.add.reduceat(flat, starts)).view(np.int64)),
                        pa.array(np.bitwise_xor.reduceat(fold(flat + np.uint64(3)), starts).view(np.int64)),
                        pa.array([len(s) for s in own], pa.int32()),
                        pa.array([x.tobytes() for x in paths], pa.binary()),
                    ],
                    names=["key", "set_a", "set_b", "shingles", "paths"],
                )
        trim()

    source = docs.select(docs[id_col].cast("bigint").alias("key"), docs[text_col].alias("text"))
    return source.mapInArrow(run, "key bigint, set_a bigint, set_b bigint, shingles int, paths binary")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections of the sets."""
    n = len(sets)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    sizes = np.diff(np.append(starts, len(flat)))
    out = np.zeros((n, n), dtype=np.float32)
    # frequent shingles by matrix products, a slice of columns at a time
    often = np.flatnonzero(sizes >= 24)
    for k in range(0, len(often), 2048):
        own = often[k : k + 2048]
        x = np.zeros((n, len(own)), dtype=np.float32)
        for c, g in enumerate(own):
            x[row[starts[g] : starts[g] + sizes[g]], c] = 1
        out += x @ x.T
    # rare ones by their few pairs
    for size in np.unique(sizes[(sizes > 1) & (sizes < 24)]):
        rows = row[starts[sizes == size][:, None] + np.arange(size)]
        for a in range(size):
            for b in range(a + 1, size):
                np.add.at(out, (rows[:, a], rows[:, b]), 1)
                np.add.at(out, (rows[:, b], rows[:, a]), 1)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix: Jaccard likeness of at least the threshold (not of a set with itself)."""
    common = intersections(sets)
    size = np.array([len(s) for s in sets], dtype=np.float32)
    # in whole numbers: 1000 * common >= 1000 t * union
    union = size[:, None] + size[None, :] - common
    out = common.astype(np.float64) >= threshold * union.astype(np.float64) - 1e-9
    np.fill_diagonal(out, False)
    return out


def _roots(adjacent: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each row the smallest key of its component in a small matrix."""
    label = keys.copy()
    big = np.iinfo(np.int64).max
    while True:
        least = np.array([min(label[i], label[a].min(initial=big)) for i, a in enumerate(adjacent)])
        if (least == label).all():
            return label
        label = least


def classes(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, links, copies, shingles), a row per document.

    ``links`` counts the other documents whose likeness is at least the threshold,
    copies included; ``copies`` those with the same shingles. ``class_id`` is the
    smallest id that links lead to. Texts without a word (null, empty, blank) have no
    shingles and no links; a text of fewer than five words is one shingle. Documents
    with a null id are not compared and have a null class. Rows with equal ids are one
    document if their shingles are equal; otherwise each row has its own links and both
    can share a class. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    signed = written(signatures(docs, p, id_col, text_col), "jaccard-signed")
    sets = written(
        signed.where("set_a IS NOT NULL").groupBy("set_a", "set_b").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("shingles").alias("shingles")), "jaccard-sets"
    )
    # one row of each set goes on: the one with its smallest key
    lead = signed.join(sets, [signed["set_a"] == sets["set_a"], signed["set_b"] == sets["set_b"], signed["key"] == sets["rep"]], "left_semi").dropDuplicates(["set_a", "set_b"])
    width = 2 + 2 * p.depth
    trees = F.transform(F.sequence(F.lit(0), F.lit(p.trees - 1)), lambda t: F.substring("paths", t * width + 1, F.lit(width)))
    members = written(lead.select(F.xxhash64("set_a", "set_b").alias("node"), F.explode(trees).alias("path")), "jaccard-trie")
    parts = components(trie_ties(members, p).select("a", "b").distinct())

    sizes = parts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / p.block).cast("int"))
    named = sets.withColumn("node", F.xxhash64("set_a", "set_b"))
    placed = written(
        parts.join(sizes, "label").join(named, "node")
        .withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int"))
        .select("node", "label", "blocks", "own", "rep", "weight", "set_a", "set_b"),
        "jaccard-parts",
    )
    texts = docs.select(docs[id_col].cast("bigint").alias("rep"), docs[text_col].alias("text")).where("rep IS NOT NULL")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard")
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                own = shingle_sets([t or "" for t in part.column("text").to_pylist()], p.words)
                # of rows with one id, the one whose shingles these are
                a, b = part.column("set_a").to_numpy(), part.column("set_b").to_numpy()
                fits = [
                    k for k, s in enumerate(own)
                    if len(s) and fold(np.array([s.sum(dtype=np.uint64)])).view(np.int64)[0] == a[k]
                    and np.bitwise_xor.reduce(fold(s + np.uint64(3))).astype(np.uint64).view(np.int64) == b[k]
                ]
                if not fits:
                    continue
                keep = part.take(pa.array(fits))
                yield pa.RecordBatch.from_arrays(
                    [*(keep.column(c) for c in ("node", "label", "blocks", "own", "weight")), pa.array([own[k].tobytes() for k in fits], pa.binary())],
                    names=["node", "label", "blocks", "own", "weight", "shingles"],
                )

    chosen = F.broadcast(placed) if placed.count() <= BROADCAST_ROWS else placed
    full = texts.join(chosen, "rep").mapInArrow(with_sets, "node bigint, label bigint, blocks int, own int, weight bigint, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = full.withColumn("other", other).select(
        "label", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "weight", "shingles"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups arrive one after another: a group ends where its key changes."""
        enter("jaccard")
        now, rows = None, {}

        def result() -> pa.RecordBatch:
            _, x, y = now
            nodes = np.array(list(rows), dtype=np.int64)
            own = np.array([r[0] for r in rows.values()])
            weight = np.array([r[1] for r in rows.values()], dtype=np.int64)
            adjacent = linked([r[2] for r in rows.values()], p.threshold)
            if x != y:  # pairs inside one block belong to that block's own comparison
                adjacent &= own[:, None] != own[None, :]
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(_roots(adjacent, nodes)), pa.array(adjacent @ weight)], names=["node", "root", "links"]
            )

        for batch in batches:
            for label, x, y, own, node, weight, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (label, x, y) != now:
                    if len(rows) > 1:
                        yield result()
                    now, rows = (label, x, y), {}
                rows[node] = (own, weight, np.frombuffer(data, dtype=np.uint64))
        if len(rows) > 1:
            yield result()

    found = written(
        paired.repartition("label", "x", "y").sortWithinPartitions("label", "x", "y").mapInArrow(compare, "node bigint, root bigint, links bigint"),
        "jaccard-found",
    )
    joined = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    # names of sets are hashes: a class is called after its smallest document
    called = joined.join(named.select("node", "rep"), "node")
    names = called.groupBy("label").agg(F.min("rep").alias("class"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_set = (
        named.join(links, "node", "left").join(joined, "node", "left").join(names, "label", "left")
        .select("set_a", "set_b", F.coalesce("class", "rep").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), (F.col("weight") - 1).alias("copies"))
    )
    none = F.lit(0).cast("bigint")
    return signed.select("key", "set_a", "set_b", "shingles").join(per_set, ["set_a", "set_b"], "left").select(
        F.col("key").cast(kind).alias(id_col), F.coalesce("class", "key").cast(kind).alias("class_id"),
        F.coalesce("links", none).alias("links"), F.coalesce("copies", none).alias("copies"), "shingles",
    )


#: rows (about 80 bytes each) that may be sent to all tasks; above it, a shuffled join
BROADCAST_ROWS = 500_000
