"""Toxicity by compression distance (operator 2).

Two zstandard dictionaries are made from labelled text, one from ordinary text and one
from toxic text, and each window of 32 words is compressed with both. The ordinary one
is trained by zstandard on windows of ordinary documents, with the most frequent words
after it. The toxic one has the passages of toxic documents as they stand, less what
ordinary documents say as well, and then all of the ordinary one: toxic documents are
mostly ordinary prose, so a window is shorter under it only where it says what toxic
documents say and ordinary ones do not, be it a word or a sequence. Words are written as
fixed codes of 6 bytes (the word, and two beginnings of it, which join inflected forms);
a match is then a whole word or beginning, and lengths do not depend on chance matches
of letters.

What toxic documents say more is told by a likelihood ratio of document counts, which
holds for a few dozen labels as well as for thousands. With fewer than
``least_documents`` toxic documents there is nothing to tell: no window has a gain, and
all documents get the score of the labels' share.

A document's features are the gains of its windows; a logistic curve fitted on the
labelled sample turns them into the probability of the label, so the threshold on the
score is calibrated.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pieces, word_hashes, written


@dataclass(frozen=True)
class Params:
    #: labelled rows of each class the model is fitted on, on average, chosen by hash
    rows_per_class: int = 6000
    #: words of a window
    window: int = 32
    #: bytes of the beginnings of words
    beginnings: tuple[int, ...] = (4, 5)
    #: segments of the ordinary dictionary, the most frequent ones
    ordinary_segments: int = 3000
    #: what toxic documents say more: log-odds of their rate against that of ordinary ones,
    #: the root of the likelihood ratio, and toxic documents
    log_odds: float = 2.0
    z: float = 4.0
    least_documents: int = 3
    #: windows of ordinary documents that the trainer sees, and bytes that it makes of them
    ordinary_windows: int = 8000
    trained_bytes: int = 18_000
    #: bytes of toxic passages, and documents that may bring the same word
    toxic_bytes: int = 64_800
    word_copies: int = 8
    threshold: float = 0.3


#: bytes of a code
CODE = 6
_SETTINGS = {
    "strategy": zstandard.STRATEGY_FAST, "target_length": 1, "min_match": CODE, "window_log": 17, "hash_log": 15,
    "chain_log": 6, "search_log": 1, "write_content_size": 0,
}


def codes(texts: list[str], beginnings: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(words, 1 + beginnings) codes of all lower-case words, and the offsets of the texts."""
    words, at, heads = word_hashes([t.lower() for t in texts], marks=True, prefixes=beginnings)
    return np.column_stack([words, *heads]), at


def as_bytes(code: np.ndarray) -> bytes:
    """The low 6 bytes of each code, one after another."""
    return np.ascontiguousarray(code.astype("<u8").reshape(-1, 1).view(np.uint8)[:, :CODE]).tobytes()


def compressor(segments: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(**_SETTINGS)
    if len(segments) < 8:
        return zstandard.ZstdCompressor(compression_params=settings)
    trained = zstandard.ZstdCompressionDict(segments, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=trained)


def trained(windows: list[bytes], params: Params) -> bytes:
    """A dictionary that zstandard makes of what recurs in the windows; too few for it are taken as they are."""
    width = CODE * (1 + len(params.beginnings))
    try:
        return zstandard.train_dictionary(params.trained_bytes, windows, k=width, d=CODE).as_bytes()
    except zstandard.ZstdError:
        return b"".join(windows)[: params.trained_bytes // width * width]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    params: Params

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: windows, sum of gains, largest gain, windows with a gain."""
        plain, other = compressor(self.ordinary), compressor(self.toxic)
        out = np.zeros((len(texts), 4))
        size = self.params.window * (1 + len(self.params.beginnings)) * CODE
        for index, own in pieces(texts, overlap=0):
            code, at = codes(own, self.params.beginnings)
            data = as_bytes(code)
            width = (1 + len(self.params.beginnings)) * CODE
            for i, lo, hi in zip(index, at[:-1] * width, at[1:] * width, strict=True):
                for start in range(lo, hi, size):
                    window = data[start : min(start + size, hi)]
                    gain = len(plain.compress(window)) - len(other.compress(window))
                    row = out[i]
                    row[0] += 1
                    if gain > 0:
                        row[1] += gain
                        row[2] = max(row[2], gain)
                        row[3] += 1
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-inputs(features) @ self.weights))


def inputs(f: np.ndarray) -> np.ndarray:
    windows = np.maximum(f[:, 0], 1)
    return np.column_stack([np.ones(len(f)), np.sqrt(f[:, 1] / windows), np.log1p(f[:, 1]), np.log1p(f[:, 2]), f[:, 3] / windows])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Fit on texts (id, text) and labels (id, label); rows without text or label do not count.

    The sample of labels is bounded (``rows_per_class``, on average) and chosen by hash
    of the id; only it is sent to the scan of the texts, so no text but the sample's
    moves. Of equal texts one row is taken, so a copied document is not counted as many.
    The driver gets the codes that pass the bounds, ``ordinary_windows`` windows, toxic
    passages up to ``toxic_bytes`` and a few numbers a sample row.
    """
    spark = docs.sparkSession
    rows = labels.where("label IN (0, 1) AND id IS NOT NULL")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.lit(0.0)
    for label, n in counts.items():
        rate = F.when(F.col("label") == label, min(1.0, params.rows_per_class / n)).otherwise(rate)
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 20)) / float(1 << 20) < rate)
    known = docs.where("text IS NOT NULL").join(F.broadcast(chosen), "id")
    sample = written(
        known.groupBy("text").agg(F.max("label").cast("int").alias("label")).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(2)).cast("int")),
        "toxicity-sample",
    )
    own = params.beginnings

    def document_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial document counts of the codes, by label."""
        for batch in batches:
            d = batch.to_pydict()
            found, labels = [], []
            code, at = codes(d["text"], own)
            for label, lo, hi in zip(d["label"], at[:-1], at[1:], strict=True):
                u = np.unique(code[lo:hi])
                found.append(u)
                labels.append(np.full(len(u), label))
            if found:
                pairs, n = np.unique(np.column_stack([np.concatenate(found).astype(np.uint64), np.concatenate(labels).astype(np.uint64)]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].astype(np.int64)), pa.array(pairs[:, 1].astype(np.int32)), pa.array(n.astype(np.int64))], names=["code", "label", "n"]
                )

    def segments(part: DataFrame) -> tuple[bytes, bytes]:
        sizes = {r["label"]: r["n"] for r in part.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        toxic_docs, plain_docs = sizes.get(1, 0), sizes.get(0, 0)
        rate = (F.col("a") + F.col("b")) / float(max(1, toxic_docs + plain_docs))

        def part_of_ratio(seen: Column, expected: Column) -> Column:
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

        ratio = part_of_ratio(F.col("a"), rate * toxic_docs) + part_of_ratio(toxic_docs - F.col("a"), (1 - rate) * toxic_docs)
        ratio += part_of_ratio(F.col("b"), rate * plain_docs) + part_of_ratio(plain_docs - F.col("b"), (1 - rate) * plain_docs)
        table = (
            part.select("text", "label").mapInArrow(document_codes, "code bigint, label int, n bigint")
            .groupBy("code")
            .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))
            .withColumn("odds", F.log((F.col("a") + 0.5) / (toxic_docs - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (plain_docs - F.col("b") + 0.5)))
            .withColumn("z", F.sqrt(F.greatest(2 * ratio, F.lit(0.0))))
            .withColumn("toxic", (F.col("a") >= params.least_documents) & (F.col("odds") >= params.log_odds) & (F.col("z") >= params.z))
        )
        telling = [r["code"] for r in table.where("toxic").orderBy(F.desc("z"), "code").limit(params.ordinary_segments).collect()]
        plain = [r["code"] for r in table.where("NOT toxic AND b > 1").orderBy(F.desc("b"), "code").limit(params.ordinary_segments).collect()]
        known = spark.sparkContext.broadcast(np.sort(np.array(telling, dtype=np.int64).view(np.uint64)))

        def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Windows of ordinary documents, and passages of toxic ones, with what only these say taken out or alone."""
            for batch in batches:
                d = batch.to_pydict()
                code, at = codes(d["text"], own)
                says = np.isin(code, known.value).any(axis=1) if len(code) else np.zeros(0, bool)
                out = []
                for label, lo, hi in zip(d["label"], at[:-1], at[1:], strict=True):
                    rows = code[lo:hi][says[lo:hi] == bool(label)]
                    step = params.window if not label else max(1, len(rows))
                    out += [(label, as_bytes(rows[k : k + step])) for k in range(0, len(rows), step)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["label", "passage"])

        found = part.select("text", "label").mapInArrow(passages, "label int, passage binary").distinct().withColumn("place", F.xxhash64("passage"))
        ordinary = trained([bytes(r["passage"]) for r in found.where("label = 0").orderBy("place", "passage").limit(params.ordinary_windows).collect()], params)
        ordinary += as_bytes(np.array(plain[::-1], dtype=np.int64).view(np.uint64))
        toxic: list[bytes] = []
        times: Counter = Counter()
        left = params.toxic_bytes
        for r in found.where("label = 1").orderBy("place", "passage").toLocalIterator():
            passage = bytes(r["passage"])
            words = {passage[k : k + CODE] for k in range(0, len(passage), CODE * (1 + len(own)))}
            if all(times[w] >= params.word_copies for w in words):
                continue  # its words are there
            toxic.append(passage[:left])
            times.update(words)
            left -= len(toxic[-1])
            if left <= 0:
                break
        return ordinary, b"".join(toxic) + ordinary

    def measured(part: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = batch.to_pydict()
                f = shared.value.features(d["text"])
                yield pa.RecordBatch.from_arrays([pa.array(d["label"], pa.int32()), *(pa.array(f[:, k]) for k in range(4))], names=["label", "f0", "f1", "f2", "f3"])

        got = part.select("text", "label").mapInArrow(run, "label int, f0 double, f1 double, f2 double, f3 double").toPandas()
        return got[["f0", "f1", "f2", "f3"]].to_numpy(), got["label"].to_numpy()

    # the curve is fitted on documents that the dictionaries have not seen
    xs, ys = [], []
    for k in (0, 1):
        ordinary, toxic = segments(sample.where(F.col("fold") == k))
        f, y = measured(sample.where(F.col("fold") != k), Model(ordinary, toxic, np.zeros(5), params))
        xs.append(f)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    # classes are sampled at different rates: weight the intercept back
    weights = logistic(inputs(x), y) if len(y) and 0 < y.sum() < len(y) else np.array([-6.0 if not y.sum() else 6.0, 0, 0, 0, 0])
    rates = {label: min(1.0, params.rows_per_class / n) for label, n in counts.items()}
    weights[0] += np.log(rates.get(0, 1.0) / rates.get(1, 1.0))
    ordinary, toxic = segments(sample)
    return Model(ordinary, toxic, weights, params)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every whole text.

    A null or empty text has no window and gets the score of no gain. Very long texts
    are read window by window. Rows are scored one by one, so repeated ids and extra
    columns do no harm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                s = shared.value.score(shared.value.features([t or "" for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s), pa.array((s >= shared.value.params.threshold).astype(np.int32))], names=[id_col, "score", "predicted"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("key"), docs[text_col].alias("text")).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")
