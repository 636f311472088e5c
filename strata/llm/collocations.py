"""Phrase collocations by prefix-free parsing (operator 12).

Texts are cut into chunks whose ends depend on content alone: a word whose hash is 0
modulo ``Params.trigger`` begins a new chunk, and a chunk runs on into the next one by as
many words as a phrase can still need. Equal passages give equal chunks wherever they
stand, so the distinct chunks with their frequencies (the dictionary of the parse) hold
everything there is to count: each distinct chunk is read once and its phrases count as
often as the chunk occurs. A phrase is counted in the chunk in which it begins, and
the words that a chunk shares with the next one begin none, so overlaps count once.

Counting is level by level. Words are counted first; pairs of words that are frequent
enough are counted by hashes in merged runs (``runs``), and only phrases all of whose
pairs may be frequent are counted as text. The filters are bit tables of a bounded size
that can only let too much through; what is returned is counted exactly, as text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import runs
from strata.llm.common import enter, fold, trim, written

#: UTF-8 bytes handled at once
BLOCK_BYTES = 4 << 20
#: a chunk begins after so many words at the latest
LONGEST_CHUNK = 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MARKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, dtype=np.uint8)  # 0 in a word, 1 blank, 2 ends a piece
_KIND[[32, 9]] = 1
_KIND[list(_MARKS)] = 2
_RANDOM = np.random.default_rng(12)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = (_RANDOM.integers(1, 1 << 62, 4096, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
UNKNOWN = "und"
BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Params:
    """``least``: a candidate's occurrences. ``longest``: words of a phrase. ``top``: phrases
    returned a language. ``covered``: a candidate goes if a longer one has at least this
    share (of 100) of its occurrences. ``filter_bits``: log2 of the bits of a filter, at most."""

    least: int = 30
    longest: int = 4
    top: int = 2000
    covered: int = 80
    scale: int = 2_000_000
    trigger: int = 12
    filter_bits: int = 30


# -- parse ---------------------------------------------------------------------------

def cut(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end at a piece's end, so no phrase is cut."""
    start = 0
    while len(text) - start > size:
        end = max(text.rfind(bytes([m]), start, start + size) for m in _MARKS) + 1
        if end <= start:  # one piece longer than that: up to its end
            ends = [e for m in _MARKS if (e := text.find(bytes([m]), start + size)) >= 0]
            end = min(ends, default=len(text) - 1) + 1
        yield text[start:end]
        start = end
    if start < len(text):
        yield text[start:]


def texts_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """(languages, lower-cased UTF-8 texts) of about ``BLOCK_BYTES``."""
    langs: list[str] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not text.is_valid:
                continue
            for part in cut(text.as_buffer().to_pybytes()):
                if size and size + len(part) > BLOCK_BYTES:
                    yield langs, texts
                    langs, texts, size = [], [], 0
                langs.append(lang)
                texts.append(part.translate(_LOWER))
                size += len(part)
    if texts:
        yield langs, texts


def gathered(data: np.ndarray, begins: np.ndarray, lens: np.ndarray) -> pa.Array:
    """Strings of ``data`` from ``begins`` on."""
    ends = np.cumsum(lens)
    at = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    at += np.repeat(begins - (ends - lens), lens)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def parse(langs: list[str], texts: list[bytes], params: Params) -> pa.Table:
    """(lang, chunk, own, n): distinct chunks of the texts, the words that begin phrases
    in them, and how often they occur. Words of a chunk are joined by one blank."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    begins = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
    n = len(begins)
    if not n:
        return pa.table({"lang": pa.array([], pa.string()), "chunk": pa.array([], pa.string()), "own": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    stops = np.flatnonzero(~inside & np.concatenate(([False], inside[:-1])))
    lens = stops - begins
    piece = np.cumsum(kind == 2, dtype=np.int32)[begins]
    first = np.concatenate(([True], piece[1:] != piece[:-1]))
    letters = np.cumsum(np.where(inside, _BYTES[raw], np.uint64(0)), dtype=np.uint64)
    mixed = fold(letters[stops - 1] - letters[begins] + _BYTES[raw[begins]] * np.uint64(3) + lens.astype(np.uint64))
    start = first | (mixed % np.uint64(params.trigger) == 0)
    place = np.arange(n)
    start |= (place - np.maximum.accumulate(np.where(start, place, 0))) % LONGEST_CHUNK == 0
    starts, pieces = np.flatnonzero(start), np.flatnonzero(first)
    upto = np.concatenate((starts[1:], [n]))
    last = np.concatenate((pieces, [n]))[np.searchsorted(pieces, starts, "right")]
    end = np.minimum(upto + params.longest - 1, last)
    blank = raw.copy()
    blank[~inside] = 32
    keep = inside.copy()
    keep[stops] = True
    offsets = np.cumsum(lens + 1) - (lens + 1)
    chunk = gathered(blank[keep], offsets[starts], offsets[end - 1] + lens[end - 1] - offsets[starts])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(text_ends, begins[starts], "right")
    names, codes = np.unique(np.array(langs, dtype=object), return_inverse=True)
    table = pa.table({"code": codes[owner].astype(np.int32), "chunk": chunk, "own": (upto - starts).astype(np.int32)})
    table = table.group_by(["code", "chunk", "own"], use_threads=False).aggregate([([], "count_all")])
    lang = pa.array(names.tolist(), pa.string()).take(table["code"].combine_chunks())
    return pa.table({"lang": lang, "chunk": table["chunk"].combine_chunks(), "own": table["own"].combine_chunks(), "n": table["count_all"].combine_chunks()})


def dictionary(docs: DataFrame, params: Params, text_col: str, lang_col: str) -> DataFrame:
    """(lang, chunk, own, n): the distinct chunks of all texts with their frequencies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("collocations")
        for langs, texts in texts_blocks(batches):
            yield from parse(langs, texts, params).to_batches()
        trim()

    source = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text_col].alias("text"))
    parsed = source.mapInArrow(run, "lang string, chunk string, own int, n bigint")
    return written(parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n")), "chunks")


# -- chunks as arrays ------------------------------------------------------------------

class Chunks:
    """Words of a block of distinct chunks."""

    def __init__(self, table: pa.Table):
        text = table["chunk"].combine_chunks()
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        self.raw = np.frombuffer(text.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        blank = self.raw == 32
        begins = np.zeros(len(self.raw) + 1, dtype=bool)
        begins[offsets[:-1]] = True
        begins[np.flatnonzero(blank) + 1] = True
        ends = np.zeros(len(self.raw) + 1, dtype=bool)
        ends[offsets[1:]] = True
        ends[:-1] |= blank
        self.blank = blank
        self.begins, self.ends = np.flatnonzero(begins[:-1]), np.flatnonzero(ends)
        starts = np.searchsorted(self.begins, offsets[:-1])
        sizes = np.diff(np.append(starts, len(self.begins)))
        place = np.arange(len(self.begins)) - np.repeat(starts, sizes)
        self.own = place < np.repeat(table["own"].to_numpy(), sizes)
        self.left = np.repeat(sizes, sizes) - place  # words from here to the chunk's end
        self.n = np.repeat(table["n"].to_numpy(), sizes)
        lang = table["lang"].combine_chunks().dictionary_encode()
        self.langs = lang.dictionary
        self.lang = np.repeat(lang.indices.to_numpy(), sizes)
        self.lang_hash = hashes(self.langs)

    def word_hashes(self) -> np.ndarray:
        """64-bit hashes of (language, word), from the bytes of a word and their places."""
        lens = self.ends - self.begins
        return fold(_hashed(self.raw, self.blank, self.begins) + lens.astype(np.uint64) ^ self.lang_hash[self.lang])


def _hashed(raw: np.ndarray, blank: np.ndarray | None, begins: np.ndarray) -> np.ndarray:
    sizes = np.diff(np.append(begins, len(raw)))
    at = np.arange(len(raw), dtype=np.int64) - np.repeat(begins, sizes)
    value = _PLACES[at & 4095]
    if len(at) and at.max() > 4095:
        value = value + fold((at >> 12).astype(np.uint64)) * np.uint64(2)
    value *= raw.astype(np.uint64) + np.uint64(1)
    if blank is not None:
        value[blank] = 0
    return np.add.reduceat(value, begins) if len(begins) else np.zeros(0, np.uint64)


def hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of a few strings."""
    data = [s.encode() + b"\0" for s in strings.to_pylist()]
    if not data:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(d) for d in data])
    return fold(_hashed(np.frombuffer(b"".join(data), dtype=np.uint8), None, ends - [len(d) for d in data]))


def chunk_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunks]:
    parts: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            size += batch.column(1).nbytes
        if size > BLOCK_BYTES:
            yield Chunks(pa.Table.from_batches(parts))
            parts, size = [], 0
    if parts:
        yield Chunks(pa.Table.from_batches(parts))


# -- filters -----------------------------------------------------------------------------

class Filter:
    """A bit a hash: what is not set cannot be frequent."""

    def __init__(self, bits: int, table: np.ndarray):
        self.bits, self.table = bits, table

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = (keys & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def bit_filter(keys: DataFrame, params: Params) -> Filter:
    """Bits of ``keys.key``: 16 a key, up to ``2 ** filter_bits`` (128 MB by default), beyond
    which the filter lets more through."""
    n = keys.count()
    bits = min(params.filter_bits, max(18, (16 * n).bit_length()))
    at = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    rows = keys.select(F.shiftright(at, 15).alias("part"), at.bitwiseAND(F.lit(32767)).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    table = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for part, found in rows.toLocalIterator():
        table[part << 12 : (part + 1) << 12] = np.frombuffer(found, dtype=np.uint8)
    return Filter(bits, table)


def pair_keys(words: np.ndarray) -> np.ndarray:
    """63-bit keys of neighbouring words (the last has none)."""
    return fold(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + (words[1:] ^ (words[1:] >> np.uint64(7)))) >> np.uint64(1)


# -- counts --------------------------------------------------------------------------------

def word_counts(chunks: DataFrame) -> DataFrame:
    """(lang, phrase, key, f) of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("collocations")
        for block in chunk_blocks(batches):
            own = np.flatnonzero(block.own)
            table = pa.table({"lang": block.lang[own], "phrase": gathered(block.raw, block.begins[own], (block.ends - block.begins)[own]), "key": block.word_hashes()[own].view(np.int64), "n": block.n[own]})
            table = table.group_by(["lang", "phrase", "key"], use_threads=False).aggregate([("n", "sum")])
            yield from named(block, table, ["lang", "phrase", "key"])
        trim()

    counted = chunks.mapInArrow(run, "lang string, phrase string, key bigint, n bigint")
    return counted.groupBy("lang", "phrase", "key").agg(F.sum("n").alias("f"))


def named(block: Chunks, table: pa.Table, columns: list[str]) -> Iterator[pa.RecordBatch]:
    lang = block.langs.take(table["lang"].combine_chunks())
    rest = {c: table[c].combine_chunks() for c in columns if c != "lang"}
    yield from pa.table({"lang": lang, **rest, "n": table["n_sum"].combine_chunks()}).to_batches()


def frequent_pairs(chunks: DataFrame, words, params: Params, tasks: int) -> DataFrame:
    """(key): hashes of neighbouring words that occur at least ``least`` times."""
    buckets = 1 << max(3, (tasks - 1).bit_length())
    shift = np.int64(63 - (buckets.bit_length() - 1))
    least = params.least

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return keys >> shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("collocations")
        sums = runs.Gathered(bucket_of)
        for block in chunk_blocks(batches):
            hashed = block.word_hashes()
            known = words.value(hashed)
            at = np.flatnonzero(block.own[:-1] & (block.left[:-1] > 1) & known[:-1] & known[1:])
            keys = pair_keys(hashed)[at].view(np.int64)
            yield from sums.add(*runs.summed(keys, block.n[at]))
        yield from sums.rest()
        trim()

    def emit(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for keys, counts in parts:
            yield pa.RecordBatch.from_arrays([pa.array(keys[counts >= least], pa.int64())], names=["key"])

    counted = written(chunks.mapInArrow(run, runs.SCHEMA), "pairs")
    return written(runs.merged(counted, tasks, emit, "key bigint", bucket_of), "frequent-pairs")


def phrase_counts(chunks: DataFrame, pairs, params: Params) -> DataFrame:
    """(lang, phrase, words, a): all phrases of 2 words and more that occur at least ``least`` times."""
    longest, least = params.longest, params.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("collocations")
        for block in chunk_blocks(batches):
            hashed = block.word_hashes()
            ok = np.concatenate((pairs.value(pair_keys(hashed)), [False])) & (block.left > 1)
            found = block.own & ok
            for n in range(2, longest + 1):
                at = np.flatnonzero(found)
                if not len(at):
                    break
                text = gathered(block.raw, block.begins[at], block.ends[at + n - 1] - block.begins[at])
                table = pa.table({"lang": block.lang[at], "phrase": text, "n": block.n[at]})
                table = table.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
                table = table.append_column("words", pa.array(np.full(len(table), n, dtype=np.int32)))
                yield from named(block, table, ["phrase", "words"])
                # one word more: the pair at its end may be frequent and in the chunk
                ahead = np.zeros(len(found), dtype=bool)
                ahead[: -(n - 1)] = ok[n - 1 :]
                found = found & ahead & (block.left > n)
        trim()

    counted = chunks.mapInArrow(run, "lang string, phrase string, words int, n bigint")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


# -- collocations -----------------------------------------------------------------------------

def collocations(docs: DataFrame, params: Params = Params(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest phrases.

    The counts, cuts and scores are those of the module's contract: ``a`` occurrences of
    the phrase, ``l`` and ``r`` of its two parts at the cut with the lowest score (the first
    of equal ones), ``n`` words of the language, score floor(scale * a / (l + r)). A phrase
    that stands in a longer candidate with at least ``covered`` of 100 of its occurrences
    goes. Null texts count as empty, a null language as ``und``; repeated rows count each;
    texts of any length are handled in parts that end at a piece's end; other columns are
    not read, so their names do not matter. Without a candidate the table is empty.
    Ties are settled by a descending, then the phrase in UTF-8 order.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = dictionary(docs, params, text_col, lang_col)
    words = written(word_counts(chunks), "words")
    frequent = words.where(F.col("f") >= params.least)
    known = sc.broadcast(bit_filter(frequent.select("key"), params))
    pairs = sc.broadcast(bit_filter(frequent_pairs(chunks, known, params, tasks), params))
    found = written(phrase_counts(chunks, pairs, params), "phrases")
    known.destroy()
    pairs.destroy()

    # parts of phrases: every cut asks for the counts of both sides
    split = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", "words", "a", split.alias("w")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = F.explode(F.array(F.struct(F.lit(True).alias("left"), F.array_join(F.slice("w", 1, F.col("k")), " ").alias("part")),
                              F.struct(F.lit(False).alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("part"))))
    asked = cuts.select("lang", "phrase", "a", "k", sides.alias("side")).select("lang", "phrase", "a", "k", "side.left", "side.part")
    counts = frequent.select("lang", F.col("phrase").alias("part"), "f").unionByName(found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    answered = asked.join(counts, ["lang", "part"])
    at_cut = answered.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    score = F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(params.scale).cast("decimal(12,0)"), (F.col("l") + F.col("r")).cast("decimal(21,0)"))
    best = at_cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # phrases inside longer ones
    inner = found.where(F.col("words") > 2).select("lang", F.col("a").alias("over"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, m), " "))))).alias("phrase"))
    over = inner.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    kept = best.join(over, ["lang", "phrase"], "left").where(
        F.col("over").isNull() | (F.col("over").cast("decimal(24,0)") * 100 < F.col("a").cast("decimal(24,0)") * params.covered))
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # a language's top phrases: of each of many parts first, so no language is one task
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = ranked.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(max(2, tasks))))
    few = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= params.top)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= params.top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return few.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
