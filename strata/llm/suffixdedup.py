"""Removal of long repeated strings by suffix sorting (operator 4).

A byte is removed if a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Texts are dealt, compressed, to parts of some megabytes by
one shuffle that all steps share; after it only messages between parts and shards move:

1. Every string of that length belongs to the place of its least 16-byte piece (by
   hash), so equal strings share a piece. A part sends its distinct pieces to buckets,
   which answer with those that another document has as well.
2. Around these a part cuts out the stretches of text whose strings belong to the
   place, and sends each distinct one once, with the smallest id, to its shard. A piece
   that stands in many different surroundings (a short line of many documents) is not cut
   into stretches but into single strings, each of which has a shard by its own hash: the
   parts first ask the buckets which of these strings other documents have as well, and
   send those only.
3. A shard sorts the suffixes of its stretches by external induction (``induced.py``,
   queues on disk) with their common prefixes, which puts equal strings next to each
   other, and answers each part with the smallest owners of its stretches' strings.
4. A part finds its stretches once; what it needs of them later (their places, not their
   texts) goes to a shard with its messages and comes back with the answers, and the part
   removes what these tell it to.

A piece, stretch or string with a third of all occurrences comes once from each part, and
different stretches of one piece are at most about ``group`` in a shard, so no bucket or
shard follows a hot string. A shard's stretches are in memory, its queues are not. Copies of a whole document are found by a digest
beforehand; they take no part in 2-4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from strata.llm.common import distinct, enter, fold, kept, trim, window_least, written
from strata.llm.induced import suffix_order


@dataclass(frozen=True)
class Params:
    #: bytes of a repeated string, and of the piece that stands for it
    length: int = 50
    piece: int = 16
    #: bytes of text of a part, and that a bucket and a shard stand for, on average
    part_bytes: int = 6_000_000
    bucket_bytes: int = 4_000_000
    #: different stretches of a piece, beyond which its strings are dealt one by one
    group: int = 10_000
    #: entries of the induced sort's queues that stay in memory
    memory: int = 2_000_000


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])


def groups_of(texts: list[bytes], size: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Lists of texts of about ``size`` bytes together (a longer text is on its own)."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield first, texts[first:i]
            first, held = i, 0
        held += len(t)
    if held:
        yield first, texts[first:]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def stretches(texts: list[bytes], p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end, piece hash, first byte of the text, bytes before the piece) of all stretches.

    ``begin`` and ``end`` are the places, in the joined texts, of the first and after the
    last string of a stretch.
    """
    raw, ends = _buffer(texts)
    none = np.zeros(0, np.int64)
    if len(raw) < p.length:
        return none, none, none, none.view(np.uint64), none, none
    words = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw.data, strides=(1,)).copy()
    piece = fold(words[: len(words) - 8] ^ (words[8:] * np.uint64(0xD6E8FEB86659FD93)))  # 16 bytes
    width = p.length - p.piece + 1
    key = (piece >> np.uint64(32) << np.uint64(32)) | np.arange(len(piece), dtype=np.uint64)
    least = window_least(key, width) & np.uint64(0xFFFFFFFF)
    inside = np.ones(len(least), dtype=bool)
    for e in ends[1:-1]:
        inside[max(0, e - p.length + 1) : e] = False
    # a text shorter than a string, too
    place = np.flatnonzero(inside)
    if not len(place):
        return none, none, none, none.view(np.uint64), none, none
    owner = least[place]
    cut = np.flatnonzero((np.diff(owner.astype(np.int64), prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1))
    begin = place[cut]
    end = place[np.append(cut[1:], len(place)) - 1] + 1
    text = np.searchsorted(ends, begin, side="right") - 1
    # the least hashes are all small: mixed once more, they spread evenly over buckets
    return text, begin, end, fold(piece[owner[cut].astype(np.int64)] ^ np.uint64(0xA5A5A5A5A5A5A5A5)), ends[text], owner[cut].astype(np.int64) - begin


#: a piece is known by 40 bits and its bucket; chance meetings only cost work
_LOW = np.uint64((1 << 40) - 1)
#: then a bit (several documents in a message, dealt by strings in an answer), then a power of two
_BIT, _POWER = np.uint64(40), np.uint64(41)


_PACKER: list = kept([])


def pack(data: bytes) -> bytes:
    """Compressed by this worker's own compressor (a new one for each call is slow)."""
    if not _PACKER:
        _PACKER.extend((zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()))
    return _PACKER[0].compress(data)


def unpack(data: bytes) -> bytes:
    if not _PACKER:
        pack(b"")
    return _PACKER[1].decompress(data)


def bucket_of(pieces: np.ndarray, buckets: int) -> np.ndarray:
    return ((pieces >> np.uint64(40)).astype(np.int64) * buckets) >> 24


def name_of(pieces: np.ndarray, buckets: int) -> np.ndarray:
    """What messages know a piece by, bucket included."""
    return (pieces & _LOW) | (bucket_of(pieces, buckets).astype(np.uint64) << _BIT)


_ODD = 0x9E3779B97F4A7C15
_POWERS: dict = kept({})


def spans_hash(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``raw[begin:end]``, from sums of all bytes before a place."""
    size = 1 << max(20, len(raw).bit_length())
    if size not in _POWERS:
        both = np.empty((2, size), dtype=np.uint64)
        for row, base in zip(both, (_ODD, pow(_ODD, -1, 1 << 64)), strict=True):
            row[0] = 1
            row[1:] = base
            np.cumprod(row, out=row)
        _POWERS.clear()
        _POWERS[size] = both
    power, back = _POWERS[size]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    return fold((sums[end] - sums[begin]) * back[begin])


def words_at(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on, without a copy."""
    return np.ndarray(max(0, len(raw) - 7), dtype="<u8", buffer=raw.data, strides=(1,))


def short_hash(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``raw[begin:end]``, all of at least 8 bytes and few of them, word by word."""
    words, size = words_at(raw), end - begin
    value = size.astype(np.uint64)
    for at in range(0, int(size.max()) if len(size) else 0, 8):
        step = np.minimum(at, size - 8)  # the last word ends with the span
        value = fold(value * np.uint64(_ODD) ^ words[begin + step])
    return value


def same_spans(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which distinct one each of ``raw[begin:end]`` is, an occurrence of each distinct one).

    Spans as of ``short_hash``. Those with equal hashes are compared byte for byte.
    """
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words, size = words_at(raw), end - begin
    value = short_hash(raw, begin, end)
    order = np.argsort(value, kind="stable")
    fresh = np.append(True, np.diff(value[order]) != 0)
    which = np.empty(len(begin), dtype=np.int64)
    which[order] = np.cumsum(fresh) - 1
    first = order[fresh]
    again = order[~fresh]
    model = first[which[again]]
    alike = bool((size[again] == size[model]).all())
    for at in range(0, int(size[again].max()) if len(again) and alike else 0, 8):
        step = np.minimum(at, size[again] - 8)
        alike = alike and bool((words[begin[again] + step] == words[begin[model] + step]).all())
    if not alike:  # a chance meeting of hashes
        names: dict[bytes, int] = {}
        which = np.array([names.setdefault(raw[b:e].tobytes(), len(names)) for b, e in zip(begin.tolist(), end.tolist(), strict=True)])
        first = np.unique(which, return_index=True)[1]
    return which, first


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _to_text(value: str | None) -> bytes:
    return value.encode("utf-8", "surrogatepass") if value else b""


def lean(table: pa.Table, size: int = 1_000_000) -> pa.Table:
    """The table in batches of about ``size`` bytes, which the JVM reads one by one."""
    trim()
    if table.nbytes <= size:
        return table
    return pa.Table.from_batches(table.combine_chunks().to_batches(max_chunksize=max(1, size * table.num_rows // table.nbytes)), table.schema)


def dealt(docs: DataFrame, parts: int, carried: list[StructField]) -> DataFrame:
    """(part, key, text, ...): compressed UTF-8 texts, the part of each row, and columns c0, c1, ... as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([pack(_to_text(t)) for t in batch.column(2).to_pylist()], pa.binary()), *batch.columns[3:]],
                names=["part", "key", "text", *(f"c{i}" for i in range(len(carried)))],
            )

    part = F.pmod(F.xxhash64("key", "text"), F.lit(parts)).cast("int").alias("part")
    rest = [f"c{i}" for i in range(len(carried))]
    shape = ", ".join(["part int, key bigint, text binary", *(f"{c} {f.dataType.simpleString()}" for c, f in zip(rest, carried, strict=True))])
    return docs.select(part, "key", "text", *rest).mapInArrow(run, shape)


def in_order(table: pa.Table) -> pa.Table:
    """A part's rows in one order, whatever order the shuffle brought them in.

    Blocks of several executors arrive as they come, and not alike in two steps: places
    that one step found by row hold for another one in this order only. Rows alike in
    both columns are interchangeable. Ids ascend, so the first row of a text has its
    smallest.
    """
    keys, texts = table.column("key").to_pylist(), table.column("text").to_pylist()
    order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0, texts[i]))
    # a plain kernel: Arrow's ``sort_by`` would start a pool of threads in every worker
    return table.combine_chunks().take(pa.array(order, pa.int64()))


def texts_of(table: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(ids, texts, has an id) of a part's rows."""
    enter("suffixdedup")
    known = np.array(table.column("key").is_valid().to_pylist(), dtype=bool)
    keys = table.column("key").fill_null(0).to_numpy()
    return keys, [unpack(t) for t in table.column("text").to_pylist()], known


def piece_messages(table: pa.Table, buckets: int, p: Params) -> pa.Table:
    """What a part sends to the buckets: its distinct pieces, with a bit for those of several documents."""
    keys, texts, known = texts_of(table := in_order(table))
    seen: set[bytes] = set()
    take = []
    for i, t in enumerate(texts):
        if known[i] and len(t) >= p.length and t not in seen:
            seen.add(t)
            take.append(i)
    found, owners, around = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, own in groups_of([texts[i] for i in take]):
        text, begin, end, piece, _, _ = stretches(own, p)
        if len(text):
            found.append(piece)
            owners.append(keys[np.array(take[first : first + len(own)])][text])
            around.append(spans_hash(_buffer(own)[0], begin, end + p.length - 1))
    return bucket_messages(table, np.concatenate(found), np.concatenate(owners), np.concatenate(around), buckets)


def bucket_messages(table: pa.Table, h: np.ndarray, d: np.ndarray, around: np.ndarray | None, buckets: int) -> pa.Table:
    """The distinct values of ``h``: whether several of the documents ``d`` have it, and in how many surroundings (rounded down)."""
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    several = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts) if len(h) else np.zeros(0, bool)
    power = np.zeros(len(starts), dtype=np.uint64)
    counts = np.diff(np.append(starts, len(h)))
    again = np.flatnonzero(np.repeat(counts > 1, counts)) if around is not None else []
    if len(again):
        which = np.repeat(np.arange(len(starts)), counts)[again]
        pairs = np.lexsort((other := around[order][again], which))
        which, other = which[pairs], other[pairs]
        fresh = np.append(True, (which[1:] != which[:-1]) | (other[1:] != other[:-1]))
        power = np.log2(np.maximum(np.bincount(which[fresh], minlength=len(starts)), 1)).astype(np.uint64)
    h = h[starts]
    bucket = bucket_of(h, buckets)
    value = (h & _LOW) | (several.astype(np.uint64) << _BIT) | (power << _POWER)
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    part = table.column("part")[0].as_py() if table.num_rows else 0
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    return pa.table({
        "bucket": pa.array(bucket[edges[:-1]].astype(np.int32)), "part": pa.array([part] * len(spans), pa.int32()),
        "pieces": pa.array([_six(value[lo:hi]) for lo, hi in spans], pa.binary()),
    })


def shared_of(table: pa.Table, group: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each message to a bucket, those of its values that several documents have, and whether they have over ``group`` surroundings."""
    sent = [_from_six(x) for x in table.column("pieces").to_pylist()]
    values = np.concatenate(sent)
    low = values & _LOW
    order = np.argsort(low)
    starts = np.flatnonzero(np.append(True, (ordered := low[order])[1:] != ordered[:-1]))
    counts = np.diff(np.append(starts, len(order)))
    several = np.maximum.reduceat((values >> _BIT & np.uint64(1))[order], starts) > 0
    total = np.add.reduceat(np.uint64(1) << (values >> _POWER)[order], starts)
    shared, hot = np.empty(len(order), dtype=bool), np.empty(len(order), dtype=bool)
    shared[order] = np.repeat((counts > 1) | several, counts)
    hot[order] = np.repeat(total > group, counts)
    cuts = np.cumsum([len(x) for x in sent])[:-1]
    out = [(x[y], z[y]) for x, y, z in zip(np.split(low, cuts), np.split(shared, cuts), np.split(hot, cuts), strict=True)]
    return [x for x, _ in out], [z for _, z in out]


def piece_answers(table: pa.Table, p: Params) -> pa.Table:
    """What a bucket answers each part: those of its pieces that several documents have, and of these those dealt by strings."""
    shared, hot = shared_of(table, p.group)
    keep = [i for i, x in enumerate(shared) if len(x)]
    parts, bucket = table.column("part").to_pylist(), table.column("bucket")[0].as_py()
    return pa.table({
        "part": pa.array([parts[i] for i in keep], pa.int32()), "shard": pa.array([bucket] * len(keep), pa.int32()),
        "shared": pa.array([_six(shared[i][~hot[i]]) for i in keep], pa.binary()),
        "hot": pa.array([_six(shared[i][hot[i]]) if hot[i].any() else None for i in keep], pa.binary()),
    })


def string_messages(left: pa.Table, right: pa.Table, buckets: int, p: Params) -> pa.Table:
    """What a part asks the buckets about the distinct strings of its hot pieces; parts without one read no text."""
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if left.num_rows and right.num_rows:
        keys, texts, known = texts_of(left)
        hot = names_in(right, "hot")
        take = [i for i, t in enumerate(texts) if known[i] and len(t) >= p.length]
        for first, own in groups_of([texts[i] for i in take]):
            text, begin, end, piece, _, _ = stretches(own, p)
            on = np.flatnonzero(are_in(name_of(piece, buckets), hot)) if len(text) else []
            if len(on):
                which, at = starts_of(begin[on], end[on])
                found.append(spans_hash(_buffer(own)[0], at, at + p.length))
                owners.append(keys[np.array(take[first : first + len(own)])][text[on][which]])
    return bucket_messages(left, np.concatenate(found), np.concatenate(owners), None, buckets)


def string_answers(table: pa.Table) -> pa.Table:
    """What a bucket answers each part: those of the strings it asked about that several documents have."""
    shared, _ = shared_of(table, 0)
    keep = [i for i, x in enumerate(shared) if len(x)]
    parts, bucket = table.column("part").to_pylist(), table.column("bucket")[0].as_py()
    return pa.table({
        "part": pa.array([parts[i] for i in keep], pa.int32()), "shard": pa.array([bucket] * len(keep), pa.int32()),
        "strings": pa.array([_six(shared[i]) for i in keep], pa.binary()),
    })


def names_in(table: pa.Table, column: str) -> np.ndarray:
    """The sorted names (``name_of``) that the buckets' answers to a part hold in a column."""
    rows = zip(table.column("shard").to_pylist(), table.column(column).to_pylist(), strict=True)
    return distinct(np.concatenate([np.zeros(0, np.uint64), *((_from_six(x) & _LOW) | (np.uint64(b) << _BIT) for b, x in rows if x)]))


def are_in(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which values are among the sorted names."""
    if not len(names):
        return np.zeros(len(values), dtype=bool)
    return names[np.minimum(np.searchsorted(names, values), len(names) - 1)] == values


def starts_of(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the stretch, and place, of each string of some stretches."""
    sizes = end - begin
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)


@dataclass
class Found:
    """The stretches of a part, by shard, and each document's places."""

    #: the part's bytes, and shard, begin and end in them of each distinct stretch
    raw: bytes
    shards: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    pieces: np.ndarray
    #: bytes before the piece in each stretch
    leads: np.ndarray
    #: index of the stretch, row and place of each occurrence
    string: np.ndarray
    row: np.ndarray
    place: np.ndarray


def pack_found(f: Found, copy: np.ndarray) -> bytes:
    """What step 4 needs of a part's stretches, and its rows that are copies."""
    copies = np.flatnonzero(copy)
    order = np.lexsort((f.place, f.row))
    row, place = f.row[order], f.place[order]
    arrays = (
        np.array([len(f.shards), len(row), len(copies)], dtype="<i8"), f.shards.astype("<i4"), (f.end - f.begin).astype("<u2"),
        f.string[order].astype("<i4"), np.diff(row, prepend=0).astype("<i4"), np.diff(place, prepend=0).astype("<i8"), copies.astype("<i4"),
    )
    # bytes of equal rank together: most are zeros
    return pack(b"".join(a.tobytes() if a.itemsize == 1 or not len(a) else np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays))


def unpack_found(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shard and length of each string; string, row and place of each occurrence; rows that are copies)."""
    raw, at = np.frombuffer(unpack(data), dtype=np.uint8), 0

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        size = np.dtype(kind).itemsize
        planes = raw[at : at + n * size].reshape(size, n)
        at += n * size
        return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64)

    strings, places, copies = take(3, "<i8").tolist()
    shards, sizes, string = take(strings, "<i4"), take(strings, "<u2"), take(places, "<i4")
    return shards, sizes, string, np.cumsum(take(places, "<i4")), np.cumsum(take(places, "<i8")), take(copies, "<i4")


def find(texts: list[bytes], take: list[int], mail: pa.Table, buckets: int, p: Params) -> Found:
    """Distinct stretches of the rows ``take`` around shared pieces, by shard.

    Around a hot piece these are its shared strings, each alone.
    """
    shared, hot, strings_shared = (names_in(mail, c) for c in ("shared", "hot", "strings"))
    own_texts = [texts[i] for i in take]
    raw, tail, before = b"".join(own_texts), p.length - 1, 0
    none = np.zeros(0, np.int64)
    # begin, end, shard, piece, bytes before it, row, place
    got: list[tuple[np.ndarray, ...]] = [(none,) * 7]
    for first, own in groups_of(own_texts):
        text, begin, end, piece, zero, lead = stretches(own, p)
        offset, before = before, before + sum(map(len, own))
        if not len(text):
            continue
        names_of = name_of(piece, buckets)
        on = np.flatnonzero(are_in(names_of, shared))
        shard = bucket_of(piece[on], buckets)
        alone = np.flatnonzero(are_in(names_of, hot)) if len(strings_shared) else []
        if len(alone):
            of, at = starts_of(begin[alone], end[alone])
            own_hash = spans_hash(_buffer(own)[0], at, at + p.length)
            few = are_in(name_of(own_hash, buckets), strings_shared)
            of, at, shard = alone[of[few]], at[few], np.append(shard, bucket_of(own_hash[few], buckets))
            lead, begin, end = np.append(lead[on], lead[of] + begin[of] - at), np.append(begin[on], at), np.append(end[on], at + 1)
            on = np.append(on, of)
        else:
            lead, begin, end = lead[on], begin[on], end[on]
        if len(on):
            low = (piece[on] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            got.append((begin + offset, end + offset + tail, shard, low, lead, np.array(take[first : first + len(own)])[text[on]], begin - zero[on]))
    begin, end, shard, low, lead, row, place = (np.concatenate(x) for x in zip(*got, strict=True))
    data = np.frombuffer(raw, dtype=np.uint8)
    which, firsts = same_spans(data, begin, end)
    # alike ones of a shard together, which compresses well
    head = np.ndarray(len(data) - 7, dtype=">u8", buffer=raw, strides=(1,))[begin[firsts]] if len(firsts) else none
    order = np.lexsort((head, shard[firsts]))
    new = np.empty(len(order), dtype=np.int64)
    new[order] = np.arange(len(order))
    i = firsts[order]
    return Found(raw, shard[i], begin[i], end[i], low[i].astype(np.uint32), lead[i].astype(np.uint8), new[which], row, place)


def part_stretches(left: pa.Table, right: pa.Table, buckets: int, p: Params) -> tuple[np.ndarray, list[bytes], np.ndarray, Found]:
    """A part's ids, texts and copies, and its stretches, from its rows and the messages to it."""
    keys, texts, known = texts_of(left)
    marks = {(k, m) for k, m in zip(right.column("key").to_pylist(), right.column("mark").to_pylist(), strict=True) if k is not None}
    copy = np.array([bool(marks) and k and (int(key), hashlib.md5(t).hexdigest()) in marks for key, t, k in zip(keys, texts, known, strict=True)], dtype=bool)
    take = [i for i, t in enumerate(texts) if known[i] and not copy[i] and len(t) >= p.length]
    return keys, texts, copy, find(texts, take, right, buckets, p)


def stretch_messages(left: pa.Table, right: pa.Table, buckets: int, p: Params) -> pa.Table:
    """What a part sends to the shards: its distinct stretches and the smallest id of each."""
    keys, _, _, f = part_stretches(left, right, buckets, p)
    return messages_of(left, keys, f)


def messages_of(left: pa.Table, keys: np.ndarray, f: Found) -> pa.Table:
    owner = np.full(len(f.shards), np.iinfo(np.int64).max)
    np.minimum.at(owner, f.string, keys[f.row] if len(f.row) else f.row)
    edges = np.append(np.flatnonzero(np.diff(f.shards, prepend=-1)), len(f.shards))
    part = left.column("part")[0].as_py() if left.num_rows else 0
    spans = [(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table({
        "shard": pa.array(f.shards[edges[:-1]].astype(np.int32)), "part": pa.array([part] * len(spans), pa.int32()),
        "stretches": pa.array([pack(b"\xff".join(f.raw[x:y] for x, y in zip(f.begin[a:b].tolist(), f.end[a:b].tolist(), strict=True))) for a, b in spans], pa.binary()),
        "pieces": pa.array([f.pieces[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
        "leads": pa.array([f.leads[a:b].tobytes() for a, b in spans], pa.binary()),
        "owners": pa.array([pack(owner[a:b].astype("<i8").tobytes()) for a, b in spans], pa.binary()),
    })


def sent_messages(left: pa.Table, right: pa.Table, buckets: int, p: Params) -> pa.Table:
    """``stretch_messages``, and a row for one of the shards with what the part will want back."""
    left = in_order(left)
    keys, _, copy, f = part_stretches(left, right, buckets, p)
    table = messages_of(left, keys, f).append_column("found", pa.nulls(len(set(f.shards.tolist())), pa.binary()))
    if not left.num_rows:
        return table
    part = left.column("part")[0].as_py()
    row = {c: pa.nulls(1, table.schema.field(c).type) for c in table.column_names}
    row |= {"shard": pa.array([part % buckets], pa.int32()), "part": pa.array([part], pa.int32()), "found": pa.array([pack_found(f, copy)], pa.binary())}
    return pa.concat_tables([table, pa.table(row)])


def ambiguous(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, lead: np.ndarray, among: np.ndarray, p: Params) -> np.ndarray:
    """Those of the stretches ``among`` that may have a string in common with another one.

    A common string has its piece and ``length - piece`` more bytes, some before the piece
    and some after. Whatever the split, it holds one of four surroundings of the piece,
    of which each has nearly the string's length. Surroundings are known by a hash: a
    chance meeting only costs work.
    """
    extra = p.length - p.piece
    cuts = [round(extra * k / 4) for k in range(5)]
    lead, begin, end = lead[among].astype(np.int64), begin[among], end[among]
    after = end - begin - lead - p.piece
    several = np.zeros(len(among), dtype=bool)
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        left, right = low, extra - high
        on = np.flatnonzero((lead >= left) & (after >= right))
        middle = begin[on] + lead[on]
        _, group, counts = np.unique(short_hash(raw, middle - left, middle + p.piece + right), return_inverse=True, return_counts=True)
        several[on[counts[group] > 1]] = True
    return among[several]


def shard_answers(table: pa.Table, p: Params) -> pa.Table:
    """What a shard answers each part: of each of its stretches the runs of strings with one smallest owner.

    Strings of one piece are in stretches of that piece only. A stretch that has no long
    enough surrounding of its piece in common with another needs no sorting: all its
    strings have the stretch's owner.
    """
    shard, back = table.column("shard")[0].as_py(), table.filter(table.column("found").is_valid())
    table = table.filter(table.column("found").is_null())
    none = [None] * back.num_rows
    if not table.num_rows:
        return pa.table({"part": back.column("part"), "shard": pa.array(none, pa.int32()), "answer": pa.array(none, pa.binary()), "found": back.column("found")})
    # all messages one after another; a byte 255 ends each stretch
    raw = np.frombuffer(b"".join(unpack(x) + b"\xff" for x in table.column("stretches").to_pylist()), dtype=np.uint8)
    end = np.flatnonzero(raw == 255)
    begin = np.append(0, end[:-1] + 1)
    ids = [np.frombuffer(unpack(x), dtype="<i8") for x in table.column("owners").to_pylist()]
    which, first = same_spans(raw, begin, end)
    owner = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(owner, which, np.concatenate(ids))
    piece = np.frombuffer(b"".join(table.column("pieces").to_pylist()), dtype="<u4")[first]
    lead = np.frombuffer(b"".join(table.column("leads").to_pylist()), dtype=np.uint8)[first]
    begin, end = begin[first], end[first]
    _, group, sizes = np.unique(piece, return_inverse=True, return_counts=True)
    several = ambiguous(raw, begin, end, lead, np.flatnonzero(sizes[group] > 1), p)
    # runs of a stretch: first string and smallest owner of each; most have a single one
    count = np.ones(len(first), dtype=np.int64)
    starts, owners = [], []
    if len(several):
        for i, x in zip(several.tolist(), smallest_owners([raw[b:e].tobytes() for b, e in zip(begin[several].tolist(), end[several].tolist(), strict=True)], owner[several], p), strict=True):
            f = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            count[i] = len(f)
            starts.append(f)
            owners.append(x[f])
    zero = np.cumsum(count) - count
    run_first, run_owner = np.zeros(int(count.sum()), dtype=np.uint8), np.empty(int(count.sum()), dtype="<i8")
    run_owner[zero] = owner
    if len(several):
        at = np.repeat(zero[several], count[several]) + starts_of(np.zeros(len(several), np.int64), count[several])[1]
        run_first[at] = np.concatenate(starts)
        run_owner[at] = np.concatenate(owners)
    out = []
    for w in np.split(which, np.cumsum([len(x) for x in ids])[:-1]):
        at = starts_of(zero[w], zero[w] + count[w])[1]
        out.append(pack(count[w].astype(np.uint8).tobytes() + run_first[at].tobytes() + run_owner[at].tobytes()))
    return pa.table({
        "part": pa.array(table.column("part").to_pylist() + back.column("part").to_pylist(), pa.int32()), "shard": pa.array([shard] * len(out) + none, pa.int32()),
        "answer": pa.array([*out, *none], pa.binary()), "found": pa.array([None] * len(out) + back.column("found").to_pylist(), pa.binary()),
    })


def removed(left: pa.Table, right: pa.Table, p: Params) -> tuple[list[bytes], list[list[tuple[int, int]]]]:
    """The texts of a part whose rows are ``in_order``, and the runs of bytes that go from each."""
    keys, texts, _ = texts_of(left)
    gone: list[list[tuple[int, int]]] = [[] for _ in texts]
    found = [x for x in right.column("found").to_pylist() if x is not None]
    if not found:
        return texts, gone
    shards, lengths, string, row, place, copies = unpack_found(found[0])
    answers = {s: a for s, a in zip(right.column("shard").to_pylist(), right.column("answer").to_pylist(), strict=True) if a is not None}
    edges = np.append(np.flatnonzero(np.diff(shards, prepend=-1)), len(shards))
    # runs of all strings one after another: the first string of each and its smallest owner
    none = np.zeros(0, np.int64)
    sizes, firsts, owners = [none], [none], [none]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        data, n = unpack(answers[int(shards[lo])]), int(hi - lo)
        sizes.append(np.frombuffer(data, dtype=np.uint8, count=n).astype(np.int64))
        total = int(sizes[-1].sum())
        firsts.append(np.frombuffer(data, dtype=np.uint8, count=total, offset=n).astype(np.int64))
        owners.append(np.frombuffer(data, dtype="<i8", count=total, offset=n + total))
    size, first, owner = np.concatenate(sizes), np.concatenate(firsts), np.concatenate(owners)
    start = np.cumsum(size) - size
    # a run ends where the next one of its string begins, or at the string's last place
    end = np.append(first[1:], 0)
    end[start + size - 1] = lengths - p.length + 1
    of = np.repeat(np.arange(len(string)), size[string])
    run = np.arange(len(of)) + np.repeat(start[string] - (np.cumsum(size[string]) - size[string]), size[string])
    goes = np.flatnonzero(owner[run] < keys[row[of]])
    of, run = of[goes], run[goes]
    for i, lo, hi in zip(*(x.tolist() for x in merged(row[of], place[of] + first[run], place[of] + end[run] - 1 + p.length)), strict=True):
        gone[i].append((lo, hi))
    for i in copies.tolist():
        gone[i] = [(0, len(texts[i]))]
    return texts, gone


def smallest_owners(strings: list[bytes], owners: np.ndarray, p: Params) -> list[np.ndarray]:
    """For each stretch, the smallest owner of each of its strings.

    One induced suffix sort of all stretches: strings that are equal are neighbours whose
    common prefix is at least their length.
    """
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    joined = np.frombuffer(b"\xff".join(strings) + b"\xff", dtype=np.uint8)
    text = np.zeros(len(joined) + 1, dtype=np.uint8)
    np.add(joined, 1, out=text[:-1], where=joined < 255)
    text[:-1][joined == 255] = 255  # no UTF-8 byte is above 244
    order, common = suffix_order(text, p.length, p.memory)
    which = np.searchsorted(begins, order, side="right") - 1
    starts_string = (order < len(joined)) & (order + p.length <= begins[which] + sizes[which])
    same = (common >= p.length) & starts_string & np.append(False, starts_string[:-1])
    lead = np.flatnonzero(~same)
    owner = np.where(starts_string, owners[which], np.iinfo(np.int64).max)
    least = np.minimum.reduceat(owner, lead)[np.cumsum(~same) - 1]
    at = np.full(len(text), np.iinfo(np.int64).max, dtype=np.int64)
    at[order[starts_string]] = least[starts_string]
    return [at[b : b + n - p.length + 1] for b, n in zip(begins, sizes, strict=True)]


def merged(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the disjoint runs of each row in order; runs that touch are one."""
    order = np.lexsort((begin, row))
    row, begin, end = row[order], begin[order], end[order]
    if not len(row):
        return row, begin, end
    # each row's runs lie after those of the row before
    shift = row * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    fresh = np.flatnonzero(np.append(True, (begin + shift)[1:] > reach[:-1]))
    last = np.append(fresh[1:], len(row)) - 1
    return row[fresh], begin[fresh], (reach - shift)[last]


def cleaned(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept binary, spans, ...) of every document.

    A null text counts as empty. Texts shorter than ``length`` bytes keep everything, as
    does a document with a null id, and of several rows with one id none removes
    from another. An empty table gives no rows; other columns are not read. ``spans``
    has the removed runs, ``kept`` the remaining bytes; columns in ``carry`` come along.
    With ``as_text``, ``kept`` is text: what is left of a character that lost bytes is dropped.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    carried = [docs.schema[c] for c in carry]
    base = docs.select(docs[id_col].cast("bigint").alias("key"), docs[text_col].alias("text"), *[docs[c].alias(f"c{i}") for i, c in enumerate(carry)])
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(1 << 24, max(64, total // p.bucket_bytes)))
    texts = dealt(base, max(1, -(-total // p.part_bytes)), carried)

    digests = base.where(f"key IS NOT NULL AND octet_length(text) >= {p.length}").select("key", F.xxhash64("key", "text").alias("at"), F.md5("text").alias("mark"))
    firsts = digests.groupBy("mark").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("mark", "first")
    parts = F.lit(max(1, -(-total // p.part_bytes)))
    copies = written(digests.join(firsts, "mark").where("key > first").select(F.pmod("at", parts).cast("int").alias("part"), "key", "mark"), "suffix-copies")

    mail = "part int, shared binary, hot binary, strings binary, key bigint, mark string, shard int"
    empty = {f.split()[0]: F.lit(None).cast(f.split()[1]) for f in mail.split(", ")}

    def message(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else v.alias(c) for c, v in empty.items()])

    pieces = texts.groupBy("part").applyInArrow(lambda t: lean(piece_messages(t, buckets, p)), "bucket int, part int, pieces binary")
    told = pieces.groupBy("bucket").applyInArrow(lambda t: lean(piece_answers(t, p)), "part int, shard int, shared binary, hot binary")
    asked = texts.groupBy("part").cogroup(told.where("hot IS NOT NULL").groupBy("part")).applyInArrow(
        lambda a, b: lean(string_messages(a, b, buckets, p)), "bucket int, part int, pieces binary"
    )
    again = asked.groupBy("bucket").applyInArrow(string_answers, "part int, shard int, strings binary")
    shared = message(told).unionByName(message(again)).unionByName(message(copies))
    sent = texts.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(
        lambda a, b: lean(sent_messages(a, b, buckets, p)), "shard int, part int, stretches binary, pieces binary, leads binary, owners binary, found binary"
    )
    answers = sent.groupBy("shard").applyInArrow(lambda t: lean(shard_answers(t, p)), "part int, shard int, answer binary, found binary")

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        left = in_order(left)
        own, runs = removed(left, right, p)
        kept = []
        for t, r in zip(own, runs, strict=True):
            at, rest = 0, []
            for begin, end in r:
                rest.append(t[at:begin])
                at = end
            kept.append(b"".join([*rest, t[at:]]))
        return lean(pa.table({
            "key": left.column("key"), "n_bytes": pa.array([len(t) for t in own], pa.int64()),
            "n_removed": pa.array([len(t) - len(k) for t, k in zip(own, kept, strict=True)], pa.int64()),
            "n_spans": pa.array([len(r) for r in runs], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()), "spans": pa.array([[x for y in r for x in y] for r in runs], pa.list_(pa.int64())),
            **{f"c{i}": left.column(f"c{i}") for i in range(len(carried))},
        }))

    got = texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        apply,
        ", ".join(
            [f"key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept {'string' if as_text else 'binary'}, spans array<bigint>"]
            + [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(carried)]
        ),
    )
    own = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
    return got.select(F.col("key").cast(kind).alias(id_col), *own, *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])


def whole_characters(df: DataFrame, bytes_col: str, text_col: str) -> DataFrame:
    """``df`` with the bytes as text; what is left of a cut character is dropped."""

    @F.pandas_udf("string")
    def decode(data: pd.Series) -> pd.Series:
        return data.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    return df.withColumn(text_col, decode(F.col(bytes_col)))
