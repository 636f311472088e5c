"""Benchmark decontamination by latent semantic retrieval (operator 3).

Documents are read as overlapping passages. Passages and benchmark items are TF-IDF
vectors over the words of the items, with document frequencies from all passages. A
randomised singular value decomposition of the passage matrix, computed in one pass
over the corpus, gives the latent space, which the items' own rows complete. Passages
whose cosine with an item is high in it are candidates; a candidate counts if the longest common subsequence with the item is
long, or if it is of middle length and the item's answer (its last words) is there too.

The pass returns sums of a fixed size for each task, which Spark adds up; only the
items and these sums are on the driver. Items are taken in blocks, so the broadcast arrays
have a bound; the corpus is read twice for each block. A document's passages are searched in the task that reads it: no text is
shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import distinct, enter, pieces, trim, word_hashes


@dataclass(frozen=True)
class Params:
    #: words of a passage, an even number; the next begins after half of them
    passage: int = 32
    #: random mixtures of the corpus
    mixtures: int = 48
    #: least cosine of a candidate
    cosine: float = 0.33
    #: share of an item's words in the common subsequence: enough alone; enough with the answer
    alone: float = 0.7
    with_answer: float = 0.55
    answer_found: float = 0.8
    #: the answer: this share of the item's words, the last ones
    answer: float = 0.25
    #: items with fewer words must be there whole
    least_words: int = 8
    #: items searched at once: each has its own row in the latent space, so this bounds its dimensions
    block_items: int = 208


@dataclass
class Items:
    """A block of benchmark items: ids, words, and the vocabulary of all."""

    ids: list
    words: list[np.ndarray]
    #: how often each word is in an item
    counts: list[dict[int, int]]
    vocabulary: np.ndarray
    table: np.ndarray

    @classmethod
    def build(cls, ids: list, texts: list[str]) -> Items:
        hashes, at, _ = word_hashes([t.lower() for t in texts], marks=True)
        words = [hashes[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]
        vocabulary = np.unique(hashes)
        table = np.zeros(1 << 20, dtype=bool)
        table[vocabulary >> np.uint64(44)] = True
        return cls(ids, words, [dict(Counter(w.tolist())) for w in words], vocabulary, table)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word, -1 for other words."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.table[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == hashes[maybe]
        out[maybe[hit]] = at[hit]
        return out

    def matrix(self, idf: np.ndarray) -> np.ndarray:
        """TF-IDF rows of the items, of length 1."""
        m = np.zeros((len(self.words), len(self.vocabulary)))
        for r, words in enumerate(self.words):
            np.add.at(m[r], np.searchsorted(self.vocabulary, words), 1.0)
        m *= idf
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norm > 0, norm, 1)


@dataclass
class Halves:
    """Half passages of some texts: their words' numbers, and which halves make passages."""

    numbers: np.ndarray
    #: half of each word that is in the vocabulary, its place among these, the number of halves
    half: np.ndarray
    slot: np.ndarray
    count: int
    #: passages: first and second half (the same one at a text's end), text, first word
    first: np.ndarray
    second: np.ndarray
    text: np.ndarray
    word: np.ndarray
    hashes: np.ndarray
    word_at: np.ndarray


def halves(texts: list[str], items: Items, p: Params) -> Halves:
    hashes, at, _ = word_hashes([t.lower() for t in texts], marks=True)
    step = p.passage // 2
    n = np.diff(at)
    count = -(-n // step)
    base = np.cumsum(count) - count
    numbers = items.numbers(hashes)
    known = np.flatnonzero(numbers >= 0)
    # half of a word: its text's first half and the steps from the text's first word
    shift = np.repeat(base * step - at[:-1], n)[known]
    half = (known + shift) // step
    starts = np.flatnonzero(np.diff(half, prepend=-1))
    slot = np.arange(len(half)) - np.repeat(starts, np.diff(np.append(starts, len(half))))
    total = int(count.sum())
    of = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(total) - base[of]
    # a text's last half is a passage only if it stands alone
    passage = np.flatnonzero((nth < count[of] - 1) | (count[of] == 1))
    second = np.where(count[of[passage]] > 1, passage + 1, passage)
    return Halves(numbers[known], half, slot, total, passage, second, of[passage], nth[passage] * step, hashes, at)


def _half_sums(h: Halves, weights: np.ndarray) -> np.ndarray:
    """Sum of the words' rows of ``weights`` for each half."""
    out = np.zeros((h.count, weights.shape[1]), dtype=np.float32)
    order = np.argsort(h.slot, kind="stable")
    edges = np.searchsorted(h.slot[order], np.arange((h.slot.max() if len(h.slot) else -1) + 2))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        own = order[lo:hi]  # at most one word of each half
        out[h.half[own]] += weights[h.numbers[own]]
    return out


def _passages(h: Halves, sums: np.ndarray, part: slice = slice(None)) -> np.ndarray:
    first, second = h.first[part], h.second[part]
    return sums[first] + sums[second] * (second > first)[:, None]


class Overlap:
    """How many of an item's words a passage's surroundings can hold, at most.

    Words of the vocabulary are bits; a passage's surroundings are the halves that its
    longest check can reach (and more), so what falls short of an item here cannot have
    a common subsequence of the needed length.
    """

    def __init__(self, items: Items, p: Params):
        size = len(items.vocabulary)
        self.reach = -(-max(map(len, items.words)) // (p.passage // 2))
        self.width, self.spare = 2 * self.reach + 2, -(-size // 8) % 8 and 8 - -(-size // 8) % 8
        own = np.zeros((len(items.words), size), dtype=bool)
        for row, words in zip(own, items.words, strict=True):
            row[np.searchsorted(items.vocabulary, words)] = True
        self.items = self._packed(own)
        # a word that an item has twice may be there twice
        self.need = np.array([p.with_answer * len(w) - (len(w) - len(c)) for w, c in zip(items.words, items.counts, strict=True)])

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.pad(np.packbits(bits, axis=1), ((0, 0), (0, self.spare))).view(np.uint64)

    def around(self, h: Halves, size: int) -> np.ndarray:
        """Bits of the words around each half."""
        rows, packed = h.half + self.reach, []
        for lo in range(0, h.count + self.width, 4096):  # a very long text has many halves
            there = np.zeros((min(4096, h.count + self.width - lo), size), dtype=bool)
            begin, end = np.searchsorted(rows, (lo, lo + 4096))
            there[rows[begin:end] - lo, h.numbers[begin:end]] = True
            packed.append(self._packed(there))
        out, have = np.concatenate(packed), 1
        while have < self.width:
            step = min(have, self.width - have)
            out = out[: len(out) - step] | out[step:]
            have += step
        return out

    def enough(self, around: np.ndarray, halves_: np.ndarray, items: np.ndarray) -> np.ndarray:
        out = np.zeros(len(items), dtype=bool)
        for lo in range(0, len(items), 20_000):
            part = slice(lo, lo + 20_000)
            common = np.bitwise_count(around[halves_[part]] & self.items[items[part]]).sum(axis=1)
            out[part] = common >= self.need[items[part]]
        return out


def _parts(batch: pa.RecordBatch, size: int = 200_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``size`` characters (a longer text is on its own): first row, texts."""
    texts = [t or "" for t in batch.column(1).to_pylist()]
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield first, texts[first:i]
            first, held = i, 0
        held += len(t)
    if texts[first:]:
        yield first, texts[first:]


_CHUNK = 64


def _summed(source: DataFrame, shape: tuple[int, ...], add: Callable[[np.ndarray, list[str]], None]) -> np.ndarray:
    """Sum over all tasks of an array that ``add`` fills in from texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        some = False
        for batch in batches:
            for _, texts in _parts(batch):
                # passes that only sum may cut very long texts
                for _, own in pieces(texts, overlap=0):
                    add(total, own)
                some = True
        if some:
            cuts = range(0, len(total), _CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array(list(cuts), pa.int32()), pa.array([total[c : c + _CHUNK].tobytes() for c in cuts], pa.binary())], names=["at", "part"])

    def merge(table: pa.Table) -> pa.Table:
        parts = table.column("part").to_pylist()
        total = np.frombuffer(parts[0], dtype=np.float64).copy()
        for x in parts[1:]:
            total += np.frombuffer(x, dtype=np.float64)
        return pa.table({"at": table.column("at")[:1], "part": pa.array([total.tobytes()], pa.binary())})

    # sums of sums: a task's share first, so that no group follows the number of tasks
    rows = source.mapInArrow(run, "at int, part binary").withColumn("side", F.pmod(F.spark_partition_id(), F.lit(32)))
    once = rows.groupBy("at", "side").applyInArrow(lambda key, t: merge(t.select(["at", "part"])), "at int, part binary")
    out = np.zeros(shape)
    for r in once.groupBy("at").applyInArrow(lambda key, t: merge(t), "at int, part binary").collect():
        part = np.frombuffer(r["part"], dtype=np.float64).reshape(-1, *shape[1:])
        out[r["at"] : r["at"] + len(part)] = part
    return out


def latent_space(source: DataFrame, items: Items, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimensions) weights that project words, the items in the space, singular values.

    One pass over the corpus gives the document frequencies and the word counts of
    random mixtures of all passages, ``A' (A R)`` for the passage matrix ``A`` and a random
    ``R``; the inverse frequencies scale the rows afterwards. Its singular vectors are those
    of the passages, to the accuracy of one power step. The items' own rows complete the
    space, so what is rare in the corpus keeps its place in it.
    """
    spark = source.sparkSession
    shared = spark.sparkContext.broadcast(items)
    size, mixtures = len(items.vocabulary), p.mixtures
    random = np.random.default_rng(3)
    start = spark.sparkContext.broadcast(random.standard_normal((size, mixtures)).astype(np.float32))

    def add(total: np.ndarray, texts: list[str]) -> None:
        h = halves(texts, shared.value, p)
        total[size, mixtures] += len(h.first)
        if not len(h.numbers):
            return
        # a passage counts once for a word: the words of its halves, less what both have
        cells = distinct(h.half * size + h.numbers)
        half, number = cells // size, cells % size
        two = h.second > h.first
        in_passages = np.bincount(h.first, minlength=h.count) + np.bincount(h.second[two], minlength=h.count)
        total[:size, mixtures] += np.bincount(number, weights=in_passages[half], minlength=size)
        opens = np.zeros(h.count, dtype=bool)
        opens[h.first[two]] = True
        both = cells[opens[half]]
        again = both[np.isin(both + size, cells, assume_unique=True)]
        total[:size, mixtures] -= np.bincount(again % size, minlength=size)
        y = _passages(h, _half_sums(h, start.value))
        of_half = np.zeros((h.count, mixtures), dtype=np.float32)
        of_half[h.first] += y
        of_half[h.second[two]] += y[two]
        for d, column in enumerate(np.ascontiguousarray(of_half.T)):
            total[:size, d] += np.bincount(h.numbers, weights=column[h.half], minlength=size)

    sums = _summed(source, (size + 1, mixtures + 1), add)
    idf = np.log((1 + sums[size, mixtures]) / (1 + np.maximum(sums[:size, mixtures], 0))) + 0.2
    own = items.matrix(idf)
    left, singular, _ = np.linalg.svd(idf[:, None] * sums[:size, :mixtures], full_matrices=False)
    left = left[:, singular > 1e-9 * max(1e-30, singular.max())]
    # all columns: where one depends on those before it, later rows may still lean on its direction
    space, _ = np.linalg.qr(np.column_stack((left, own.T)))
    found = own @ space
    norm = np.linalg.norm(found, axis=1, keepdims=True)
    return (idf[:, None] * space).astype(np.float32), (found / np.where(norm > 0, norm, 1)).astype(np.float32), np.sqrt(singular)


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, a machine word at a time (bit-parallel)."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(item)) - 1
    row = full
    for m in [masks[w] for w in text.tolist() if w in masks]:
        u = row & m
        row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def verdict(item: np.ndarray, near: np.ndarray, p: Params) -> tuple[bool, float, float]:
    """(contaminated, share of the item's words in order, share of its answer)."""
    n = len(item)
    share = common_subsequence(item, near) / n
    tail = max(1, round(n * p.answer))
    answer = common_subsequence(item[-tail:], near) / tail
    if n < p.least_words:
        whole = any(np.array_equal(near[i : i + n], item) for i in range(len(near) - n + 1))
        return whole, share, answer
    return share >= p.alone or (share >= p.with_answer and answer >= p.answer_found), share, answer


def search(docs: DataFrame, benchmark: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, cosine, common, answer, first_word): a row for each document and item that it contains.

    Words are lower-case, cut at blanks and ASCII punctuation. Null and empty texts, and
    items without words, are in no result. Repeated items are reported under each id
    (an item row that is there twice gives its rows twice), repeated documents in each row.
    Whole texts are searched, very long ones too, passage by passage; of the passages of a
    document that hold an item the one with the longest common subsequence is reported,
    the first of equal ones. Other columns are not read, so their names do not matter.
    An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    shape = f"`{id_col}` {kind}, `{item_id}` {item_kind}, cosine double, common double, answer double, first_word int"
    source = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    rows = benchmark.select(benchmark[item_id].alias("id"), benchmark[item_text].alias("text")).where("text RLIKE '[^\\\\x00-\\\\x2f]'")
    block: list = []

    def searched(block: list) -> DataFrame | None:
        items = Items.build([r["id"] for r in block], [r["text"] for r in block])
        if not len(items.vocabulary):
            return None
        weights, rows_in_space, _ = latent_space(source, items, p)
        shared = spark.sparkContext.broadcast((items, weights, rows_in_space))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            enter("decontam")
            own, project, targets = shared.value
            longest, overlap = max(map(len, own.words)), Overlap(own, p)
            for batch in batches:
                for first, texts in _parts(batch):
                    best: dict[tuple[int, int], tuple] = {}
                    h = halves(texts, own, p)
                    sums, around = _half_sums(h, project), None
                    for lo in range(0, len(h.first), 4096):
                        part = slice(lo, lo + 4096)
                        y = _passages(h, sums, part)
                        norm = np.linalg.norm(y, axis=1, keepdims=True)
                        cosine = (y / np.where(norm > 0, norm, 1)) @ targets.T
                        rows, found = np.nonzero(cosine >= p.cosine)
                        if len(rows) and around is None:
                            around = overlap.around(h, len(own.vocabulary))
                        if len(rows):
                            few = overlap.enough(around, h.first[lo + rows], found)
                            rows, found = rows[few], found[few]
                        seen, region = -1, set()
                        for i, item in zip(rows.tolist(), found.tolist(), strict=True):
                            text, words = int(h.text[lo + i]), own.words[item]
                            begin, end = h.word_at[text], h.word_at[text + 1]
                            at = begin + h.word[lo + i]
                            if i != seen:
                                seen, region = i, set(h.hashes[max(begin, at - longest) : min(end, at + p.passage + longest)].tolist())
                            # no subsequence is longer than the words that are there at all
                            there = sum([n for w, n in own.counts[item].items() if w in region])
                            if there < p.with_answer * len(words):
                                continue
                            near = h.hashes[max(begin, at - len(words)) : min(end, at + p.passage + len(words))]
                            hit, share, answer = verdict(words, near, p)
                            key = (text, item)
                            if hit and (key not in best or share > best[key][1]):
                                best[key] = (float(cosine[i, item]), share, answer, int(h.word[lo + i]))
                    if best:
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array([first + t for t, _ in best])),
                                pa.array([own.ids[i] for _, i in best], pa.int64()) if item_kind == "bigint" else pa.array([own.ids[i] for _, i in best]),
                                *(pa.array([v[k] for v in best.values()], pa.float64()) for k in range(3)), pa.array([v[3] for v in best.values()], pa.int32()),
                            ],
                            names=[id_col, item_id, "cosine", "common", "answer", "first_word"],
                        )
            trim()

        return source.mapInArrow(run, shape)

    found: list[DataFrame] = []

    def take(block: list) -> None:
        got = searched(block)
        if got is not None:
            found.append(got)

    for r in rows.orderBy("id", "text").toLocalIterator():
        block.append(r)
        if len(block) == p.block_items:
            take(block)
            block = []
    if block:
        take(block)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], shape)
