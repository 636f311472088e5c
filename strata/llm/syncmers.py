"""Document fingerprints from closed syncmers (operator 5).

A k-mer of code points is a closed syncmer if the least hash among its inner s-mers is
that of its first or last s-mer: the choice depends on the k-mer alone, so an edit
elsewhere moves no anchor. The fingerprint deals a text's distinct anchors into bins by
their hash and keeps the least of each bin with its place, so it is of bounded size for
any text. Two fingerprints are compared bin by bin: an anchor is common if both have
it, and counts for the likeness if it is in line with the others, wherever in the text
they all stand. The share of such bins estimates the Jaccard likeness of the anchor sets.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import code_points, fold, pieces, window_least


@dataclass(frozen=True)
class Params:
    #: code points of an anchor and of its inner pieces
    k: int = 16
    s: int = 6
    #: bins of a fingerprint, at most 256
    bins: int = 128
    #: shifts of common anchors may differ by this share of the longer text, or by this many code points, without a look at their order
    drift: float = 0.125
    least_drift: int = 64


def _rolling(points: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` code points."""
    if len(points) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(points) - n + 1, dtype=np.uint64)
    for i in range(n):
        h *= np.uint64(0x100000001B3)
        h += points[i : len(points) - n + 1 + i]
    return fold(h)


def anchors(points: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers in one run of code points."""
    if len(points) < p.k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = _rolling(points, p.s)
    width = p.k - p.s + 1
    least = window_least(inner, width)
    at = np.flatnonzero((inner[: len(least)] == least) | (inner[width - 1 :] == least))
    # the k-mer's hash from hashes of three inner pieces that cover it
    h = inner[at]
    for shift in (p.s, p.k - p.s):
        h = h * np.uint64(0x9E3779B97F4A7C15) + inner[at + shift]
    return at, fold(h)


@dataclass
class Prints:
    """Fingerprints of several texts: hashes and places by bin (place -1: empty bin)."""

    hashes: np.ndarray
    places: np.ndarray
    chars: np.ndarray

    def text(self) -> list[str]:
        """Hexadecimal text: code points, then of each bin its hash and place."""
        raw = np.empty((*self.hashes.shape, 2), dtype="<u4")
        raw[..., 0] = self.hashes
        raw[..., 1] = self.places.astype(np.int64) & 0xFFFFFFFF
        return [f"{int(n):x}:" + r.tobytes().hex() if n else "" for n, r in zip(self.chars, raw, strict=True)]


def prints(texts: list[str], p: Params) -> Prints:
    """Fingerprints of whole texts. A text without an anchor has itself as only anchor."""
    n, bins = len(texts), p.bins
    best = np.full(n * bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    place = np.full(n * bins, -1, dtype=np.int64)
    base = np.zeros(n, dtype=np.int64)
    for index, own in pieces(texts, overlap=p.k - 1):
        points, ends = code_points(own)
        at, h = anchors(points, p)
        piece = np.searchsorted(ends, at, side="right") - 1
        inside = at + p.k <= ends[piece + 1] if len(at) else np.zeros(0, bool)
        at, h, piece = at[inside], h[inside], piece[inside]
        doc = index[piece]
        cell = doc * bins + (h % np.uint64(bins)).astype(np.int64)
        # where pieces of one text follow each other, places go on
        shift = np.zeros(len(own), dtype=np.int64)
        for j, i in enumerate(index):
            shift[j] = base[i]
            base[i] += max(0, len(own[j]) - p.k + 1)
        spot = at - ends[piece] + shift[piece]
        value = h // np.uint64(bins)
        order = np.lexsort((spot, value, cell))
        first = order[np.flatnonzero(np.diff(cell[order], prepend=-1))]
        c, v, s = cell[first], value[first], spot[first]
        better = v < best[c]  # of equal anchors the first place stays
        best[c[better]], place[c[better]] = v[better], s[better]
    best, place = best.reshape(n, bins), place.reshape(n, bins)
    for i in np.flatnonzero((place < 0).all(axis=1)):
        if texts[i]:
            h = int.from_bytes(hashlib.blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            best[i, h % bins], place[i, h % bins] = h // bins, 0
    return Prints(np.where(place < 0, 0, best & np.uint64(0xFFFFFFFF)).astype(np.uint32), place, np.array(list(map(len, texts)), dtype=np.int64))


def in_line(a: np.ndarray, b: np.ndarray) -> int:
    """The most anchors, given by their places in two texts, that come in one order in both."""
    tails: list[int] = []  # the least last place in ``b`` of a chain of each length
    for place in b[np.lexsort((b, a))].tolist():
        at = bisect_right(tails, place)
        tails[at : at + 1] = [place]
    return len(tails)


def likeness(a: Prints, b: Prints, p: Params) -> np.ndarray:
    """Share of common bins in line, less those out of line, among those that either has; 1 for two empty texts.

    A bin is common if both texts have its anchor. If the shifts of a pair's common anchors
    (place in ``b`` less place in ``a``) lie within one drift of each other, all are in line;
    else those in line are the most that come in one order in both. So a passage in front
    or inside, or a cut beginning, costs only the anchors that it holds or hides, and
    anchors that have changed places count against the others.
    """
    used_a, used_b = a.places >= 0, b.places >= 0
    room = np.maximum(p.least_drift, p.drift * np.maximum(a.chars, b.chars))
    same = used_a & used_b & (a.hashes == b.hashes)
    used = (used_a | used_b).sum(axis=1)
    common = same.sum(axis=1)
    shift = b.places - a.places
    big = np.iinfo(np.int64).max >> 2
    spread = np.where(same, shift, -big).max(axis=1) - np.where(same, shift, big).min(axis=1)
    agreed = common.copy()
    for i in np.flatnonzero((common > 1) & (spread > room)):
        agreed[i] = in_line(a.places[i][same[i]], b.places[i][same[i]])
    return np.where(used > 0, np.maximum(0, 2 * agreed - common) / np.maximum(used, 1), 1.0)


def _rows(p: Prints, index: np.ndarray | slice) -> Prints:
    return Prints(p.hashes[index], p.places[index], p.chars[index])


def fingerprints(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every whole text; a null text counts as empty, whose
    fingerprint is the empty string. Rows are answered one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                f = prints([t or "" for t in part.column(1).to_pylist()], params)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(f.chars), pa.array(f.text(), pa.string())], names=[id_col, "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("key"), docs[text_col].alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_chars bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the following text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame, id_col: str, text_col: str, rows_per_chunk: int = 2000) -> DataFrame:
    """(chunk, guest, key, text): documents in descending id order, cut into chunks.

    Every chunk also has, as a guest, the first document of the next one (the last
    chunk: that of the first), so each document's follower is in its own task. Chunk
    borders are ids: quantiles of the id column, one number a chunk on the driver, and
    at most four chunks for each of the session's shuffle partitions. Ids are integers.
    Null ids come last; rows of equal ids are ordered by their texts.
    """
    spark = docs.sparkSession
    keys = docs.select(docs[id_col].alias("key"))
    n = keys.count()
    # a chunk is streamed, so it may be long: there are at most a few for each task
    chunks = max(1, min(-(-n // rows_per_chunk), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    probs = [i / chunks for i in range(1, chunks)]
    found = sorted({int(x) for x in keys.where("key IS NOT NULL").approxQuantile("key", probs, 0.25 / chunks)}) if probs else []
    cuts = np.array(found, dtype=np.int64)
    last = len(cuts)

    @F.pandas_udf("int")
    def chunk_of(key: pd.Series) -> pd.Series:
        # descending: ids above the last cut are in chunk 0; null ids close the last chunk
        known = key.notna()
        at = np.full(len(key), last, dtype=np.int32)
        at[known.to_numpy()] = last - np.searchsorted(cuts, key[known].to_numpy().astype(np.int64), side="left")
        return pd.Series(at, dtype="int32")

    # what comes first in each chunk: its largest id (a row a chunk; no texts)
    placed = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text")).withColumn("chunk", chunk_of("key"))
    heads = {r["chunk"]: r["key"] for r in placed.groupBy("chunk").agg(F.max("key").alias("key")).collect()}
    order = sorted(heads)
    host = {order[i]: order[i - 1] for i in range(len(order))}  # the chunk that the first document of a chunk also visits
    table = spark.createDataFrame([(c, heads[c], host[c]) for c in order] or [(0, None, 0)], "chunk int, head bigint, host int")
    joined = placed.join(F.broadcast(table), "chunk")
    visits = F.when(F.col("key").eqNullSafe(F.col("head")), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return (
        joined.withColumn("guest", F.explode(visits))
        .withColumn("chunk", F.when(F.col("guest"), F.col("host")).otherwise(F.col("chunk")))
        .select("chunk", "guest", "key", "text")
    )


def compare_neighbours(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness (a row a document).

    The next document is the one of the next smaller id; after the last comes the first.
    A document alone in its table is its own next. Null texts count as empty; of rows
    with equal ids the smaller text is first; null ids come last.
    """
    ordered = in_order(docs, id_col, text_col)
    dealt = ordered.repartition("chunk").sortWithinPartitions("chunk", "guest", F.col("key").desc_nulls_last(), F.coalesce("text", F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int | None] = []
        texts: list[str] = []
        now, closed = None, False  # the chunk at hand; its last document waits for the guest

        def out(upto: int) -> pa.RecordBatch:
            changed = [edited(texts[i], texts[i + 1]) for i in range(upto)]
            own, new = prints(texts[: upto + 1], params), prints(changed, params)
            a, b = _rows(own, slice(0, upto)), _rows(own, slice(1, upto + 1))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[:upto], pa.int64()), pa.array(a.chars),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                    pa.array(a.text(), pa.string()), pa.array(new.text(), pa.string()),
                    pa.array(likeness(a, new, params)), pa.array(likeness(a, b, params)),
                ],
                names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            for chunk, guest, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != now:
                    keys, texts, now, closed = [], [], chunk, False
                if guest and closed:
                    continue  # equal ids: the first of them is the follower
                keys.append(key)
                texts.append(text or "")
                if guest:
                    closed = True
                if len(texts) > 1 and (guest or len(texts) > 500 or sum(map(len, texts[-20:])) > 1 << 20):
                    yield out(len(texts) - 1)
                    keys, texts = keys[-1:], texts[-1:]

    kind = docs.schema[id_col].dataType.simpleString()
    got = dealt.mapInArrow(
        run, "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return got.select(F.col("key").cast(kind).alias(id_col), *[c for c in got.columns if c != "key"])
