"""Counts by key in sorted, compressed runs that Spark deals out and a heap merges.

A task turns what it has seen into runs: keys in ascending order with their counts,
cut into blocks of at most ``BLOCK`` keys, each a row (bucket, first, n, keys, counts)
with zstd-packed arrays. A bucket is a range of keys. Spark shuffles the rows by bucket
and sorts them by their first key (spilling as it needs to); the task of a bucket then
reads the blocks of all runs as one merge: a heap of the open blocks, by last key, gives
away all entries below the first key of the next block. So a key costs one entry a run
however often it occurs, and a task holds one open block a run and not its bucket.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

#: keys of a block, at most
BLOCK = 8192
#: entries that a task sorts at once, about; and runs of a bucket that are merged at once
HELD, FAN = 2_000_000, 512
SCHEMA = "bucket int, first bigint, n int, keys binary, counts binary"


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs, bytes of equal rank together."""
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(data)[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys without their first one, as differences."""
    return pack(np.diff(keys, prepend=keys[:1]))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts[order], at)


def blocks(buckets: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the blocks of a run; ``buckets`` ascends with ``keys``."""
    edges = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(keys) else np.zeros(0, np.int64)
    for a, b in zip(edges, [*edges[1:], len(keys)]):
        for i in range(a, b, BLOCK):
            yield int(buckets[a]), i, min(b, i + BLOCK)


def rows_of(keys: np.ndarray, counts: np.ndarray, bucket_of: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
    """A run as rows of ``SCHEMA``."""
    out = [(b, int(keys[i]), j - i, pack_keys(keys[i:j]), pack(counts[i:j])) for b, i, j in blocks(bucket_of(keys), keys)]
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=["bucket", "first", "n", "keys", "counts"])


class Gathered:
    """Counts of a task: sorted away into a run whenever ``HELD`` entries have come."""

    def __init__(self, bucket_of: Callable[[np.ndarray], np.ndarray]):
        self.bucket_of = bucket_of
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts))
        self.n += len(keys)
        if self.n >= HELD:
            joined = summed(*map(np.concatenate, zip(*self.parts)))
            if len(joined[0]) * 2 > HELD:  # else much was equal: go on with the sums
                yield rows_of(*joined, self.bucket_of)
                joined = (joined[0][:0], joined[1][:0])
            self.parts, self.n = [joined], len(joined[0])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            yield rows_of(*summed(*map(np.concatenate, zip(*self.parts))), self.bucket_of)
        self.parts, self.n = [], 0


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first key, keys, counts) of every block."""
    for batch in batches:
        for first, keys, counts in zip(batch.column("first").to_pylist(), batch.column("keys"), batch.column("counts")):
            yield first, np.cumsum(unpack(keys.as_buffer())) + first, unpack(counts.as_buffer())


def merge(incoming: Iterator[tuple[int, np.ndarray, np.ndarray]], held: int = HELD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in ascending order, each once, with their sums, from blocks in the order of their first keys."""
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # open blocks by last key
    waiting, limit, seq = 0, held, 0

    def below(bound: int | None) -> tuple[np.ndarray, np.ndarray] | None:
        nonlocal waiting
        out = []
        while heap and (bound is None or heap[0][0] < bound):
            _, _, k, c = heapq.heappop(heap)
            out.append((k, c))
        if bound is not None:
            for i, (last, s, k, c) in enumerate(heap):  # these reach beyond the bound
                cut = int(np.searchsorted(k, bound))
                if cut:
                    out.append((k[:cut], c[:cut]))
                    heap[i] = (last, s, k[cut:], c[cut:])
        waiting = sum(len(b[2]) for b in heap)
        return summed(*map(np.concatenate, zip(*out))) if out else None

    for first, keys, counts in incoming:
        if waiting >= limit:
            out = below(first)
            if out is not None:
                yield out
            limit = max(held, 2 * waiting)
        heapq.heappush(heap, (int(keys[-1]), seq, keys, counts))
        seq, waiting = seq + 1, waiting + len(keys)
    out = below(None)
    if out is not None:
        yield out


def merged(frame: DataFrame, tasks: int, emit: Callable[[Iterator[tuple[np.ndarray, np.ndarray]]], Iterator[pa.RecordBatch]], schema: str,
           bucket_of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``emit`` over the merged (keys, counts) of each bucket, in key order.

    ``frame`` is a written table of ``SCHEMA``. While a bucket has more than ``FAN`` runs,
    its runs are joined into longer ones first, as many at a time as a task may hold.
    """
    columns = ("bucket", "first", "n", "keys", "counts")
    while True:
        top = frame.groupBy("bucket").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n")).agg(
            F.max(F.col("blocks") - F.floor(F.col("n") / BLOCK))).first()[0]
        if (top or 0) <= FAN:
            break

        def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gathered = Gathered(bucket_of)
            for _, keys, counts in opened(batches):
                yield from gathered.add(keys, counts)
            yield from gathered.rest()

        salted = frame.select(*columns).withColumn("part", F.col("bucket") * 1000 + F.pmod(F.xxhash64("keys"), F.lit(max(2, -(-top // FAN)))))
        joined = written(salted.repartition(tasks, "part").sortWithinPartitions("part").select(*columns).mapInArrow(longer, SCHEMA), "runs")
        after = joined.count()
        if after >= frame.count():  # nothing was joined: runs are as long as a task may hold
            frame = joined
            break
        frame = joined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(merge(opened(batches)))

    by_key = frame.select(*columns).repartition(tasks, "bucket").sortWithinPartitions("bucket", "first")
    return by_key.mapInArrow(run, schema)
