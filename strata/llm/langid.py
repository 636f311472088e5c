"""Language identification (operator 1).

Multinomial naive Bayes over hashed character n-grams (1 to 3 folded code points).
Counts come from a bounded sample of labelled rows, as partial counts of each task
that Spark adds up; the log-probability matrix (``buckets x languages``) is broadcast;
texts are scored in batches: one gather of matrix rows, one sum over each text.

A text's score is the model's probability of its language after its log-odds are
divided by a temperature fitted on a held-back part of the sample (n-grams of a text
are far from independent, so raw posteriors are always near 1).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata.llm.common import code_points, enter, pieces, segment_sums, trim

#: no language: null texts and texts without a letter
UNDETERMINED = "und"
_FOLD: list[np.ndarray] = []


def folded() -> np.ndarray:
    """Code point -> lower-case letter, or a blank for all else (planes above 0 as they are)."""
    if not _FOLD:
        table = np.full(0x10000, 32, dtype=np.uint32)
        for i in range(0x10000):
            c = chr(i)
            if c.isalpha() or unicodedata.combining(c):
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _FOLD.append(table)
    return _FOLD[0]


def ngram_buckets(points: np.ndarray, bits: int) -> list[np.ndarray]:
    """Buckets of the n-grams that end at each place, for n of 1, 2 and 3."""
    c = folded()[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        c = np.where(high, points, c)
    shift = np.uint32(32 - bits)
    h = (c + np.uint32(1)) * np.uint32(2654435761)
    out = [h >> shift]
    for _ in range(2):
        nxt = c.copy()
        nxt[1:] += h[:-1] ^ (h[:-1] >> np.uint32(13))
        h = (nxt + np.uint32(len(out))) * np.uint32(2246822519)
        h ^= h >> np.uint32(15)
        out.append(h >> shift)
    return out


def continued(index: np.ndarray, last: int) -> np.ndarray:
    """Which pieces go on a text that an earlier piece began; ``last``: text of the piece before."""
    return np.diff(index, prepend=last) == 0


@dataclass(frozen=True)
class Params:
    #: labelled rows a language that the model is fitted on, on average; the choice is by hash
    rows_per_language: int = 3000
    #: hash buckets (a power of two)
    bits: int = 16
    smoothing: float = 0.5
    #: one in so many sample rows fits the temperature instead of the counts
    hold_back: int = 5


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: (buckets, languages) float32
    log_prob: np.ndarray
    log_prior: np.ndarray
    temperature: float
    bits: int = field(default=16)

    def log_odds(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of log-probabilities by text and language, and the number of n-grams."""
        total = np.zeros((len(texts), len(self.languages)))
        grams = np.zeros(len(texts))
        last = -1
        for index, own in pieces(texts, overlap=2):
            points, ends = code_points(own)
            later = continued(index, last)
            last = int(index[-1])
            if not len(points):
                continue
            score = np.zeros((len(own), len(self.languages)))
            for n, bucket in enumerate(ngram_buckets(points, self.bits), 1):
                # the first places have no whole n-gram, or the piece before had it
                starts = np.minimum(ends[:-1] + np.where(later, 2, n - 1), ends[1:])
                score += segment_sums(self.log_prob[bucket], starts, ends[1:])
                np.add.at(grams, index, ends[1:] - starts)
            np.add.at(total, index, score)
        return total, grams

    def predict(self, texts: list[str | None], lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        odds, grams = self.log_odds([t or "" for t in texts])
        p = probabilities(odds, grams, self.log_prior, self.temperature)
        best = p.argmax(axis=1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, p[np.arange(len(p)), best], 0.0)


def probabilities(odds: np.ndarray, grams: np.ndarray, prior: np.ndarray, temperature: float) -> np.ndarray:
    """Softmax of the log-odds, damped by the square root of the number of n-grams."""
    z = odds / (temperature * np.sqrt(np.maximum(grams, 1)))[:, None] + prior
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def sampled(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of each language, by the hash of their ids: the same rows at
    every run, whatever the partitions. One aggregate counts the languages."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate: Column = F.lit(0.0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, min(1.0, rows / n)).otherwise(rate)
    return labelled.where((F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 20)) / float(1 << 20)) < rate)


def fit(labelled: DataFrame, params: Params = Params()) -> Model:
    """Fit on (id, text, lang); rows without text, letter or language do not count.

    Partial counts of each task (one row a language) are added up by Spark; the driver
    gets ``languages x buckets`` counts, a bound that does not follow the input.
    """
    spark = labelled.sparkSession
    base = labelled.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    sample = sampled(base, params.rows_per_language).select(
        "lang", "text", (F.pmod(F.xxhash64(F.lit("hold"), "id"), F.lit(params.hold_back)) == 0).alias("held")
    )
    bits = params.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("langid")
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            d = batch.to_pydict()
            for lang in set(d["lang"]):
                own = [t for t, x in zip(d["text"], d["lang"], strict=True) if x == lang]
                c = sums.setdefault(lang, np.zeros(1 << bits, dtype=np.int64))
                rows[lang] = rows.get(lang, 0) + len(own)
                last = -1
                for index, part in pieces(own, overlap=2):
                    points, ends = code_points(part)
                    later = continued(index, last)
                    last = int(index[-1])
                    for n, bucket in enumerate(ngram_buckets(points, bits), 1):
                        whole = np.ones(len(points), dtype=bool)
                        for k in range(2):
                            begins = ends[:-1][np.where(later, 2, n - 1) > k] + k
                            whole[begins[begins < len(points)]] = False
                        c += np.bincount(bucket[whole], minlength=1 << bits)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at]), pa.array([rows[lang]] * len(at), pa.int64())],
                names=["lang", "bucket", "n", "rows"],
            )

    cells = (
        sample.where("NOT held").select("lang", "text")
        .mapInArrow(count, "lang string, bucket int, n bigint, rows bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")).toPandas()
    )
    languages = sorted(cells["lang"].unique())
    counts = np.zeros((1 << bits, len(languages)))
    for k, lang in enumerate(languages):
        own = cells[cells["lang"] == lang]
        counts[own["bucket"].to_numpy(), k] = own["n"].to_numpy()
    if not languages:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0), 1.0, bits)
    smooth = counts + params.smoothing
    log_prob = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    flat = np.log(np.full(len(languages), 1.0 / len(languages)))
    raw = Model(languages, log_prob, flat, 1.0, bits)
    shared = spark.sparkContext.broadcast(raw)

    grid = np.geomspace(0.1, 30, 24)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(grid))
        model = shared.value
        for batch in batches:
            d = batch.to_pydict()
            keep = [i for i, x in enumerate(d["lang"]) if x in model.languages]
            if keep:
                odds, grams = model.log_odds([d["text"][i] for i in keep])
                truth = np.array([model.languages.index(d["lang"][i]) for i in keep])
                for g, t in enumerate(grid):
                    p = probabilities(odds, grams, model.log_prior, t)[np.arange(len(truth)), truth]
                    out[g] -= np.log(np.maximum(p, 1e-6)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid), dtype=np.int32)), pa.array(out)], names=["g", "loss"])

    loss = {r["g"]: r["loss"] for r in sample.where("held").select("lang", "text").mapInArrow(losses, "g int, loss double").groupBy("g").agg(F.sum("loss").alias("loss")).collect()}
    # the most cautious temperature whose loss is nearly the least
    held = sample.where("held").count()
    best = max((g for g in loss if loss[g] <= min(loss.values()) + 0.005 * held), default=0)
    return Model(languages, log_prob, flat, float(grid[best]), bits)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(id, lang_pred, score) of every whole text; with ``carry`` all columns of ``docs`` too.

    A null text, an empty one and one without a letter give ``und`` with score 0. Ties
    go to the language first in alphabetical order. Every row is answered on its own,
    so repeated and null ids do no harm. Other columns are read only if they come along;
    one that is called ``lang_pred`` or ``score`` then gives way to the answer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    answer = ("lang_pred", "score")
    kept = [f for f in docs.schema.fields if f.name not in answer] if carry else [docs.schema[id_col]]
    # a text that comes along is sent once
    along = [f.name for f in kept].index(text_col) if text_col in [f.name for f in kept] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("langid")
        for batch in batches:
            own, lettered = batch.columns[1 : 1 + len(kept)], batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            names, score = shared.value.predict((batch.columns[-1] if along is None else own[along]).to_pylist(), lettered)
            yield pa.RecordBatch.from_arrays([*own, pa.array(names, pa.string()), pa.array(score)], names=[*(f.name for f in kept), *answer])
        trim()

    lettered = F.coalesce(docs[text_col].rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    source = docs.select(lettered, *[docs[f.name].alias(f"c{i}") for i, f in enumerate(kept)], *([docs[text_col].alias("judged")] if along is None else []))
    return source.mapInArrow(run, StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
