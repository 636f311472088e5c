"""Helpers shared by the operators: shared folder, Arrow streaming, vectorised text."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import strata
from strata.session import shared_dir

#: characters handled at once by the vectorised text code; longer texts are cut in
#: overlapping pieces of this size, so memory does not follow the longest text
BLOCK_CHARS = 1 << 20


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, as a zip.

    Batches of rows to Python hold at most 1,000 rows unless the session says otherwise:
    with Spark's 10,000 some thousand long texts would be in memory at once.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, "1000")
    if getattr(sc, "_strata_shipped", False):
        return
    home = Path(strata.__file__).parent
    name = Path(tempfile.mkdtemp(prefix="strata-py-")) / "strata.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    sc.addPyFile(str(name))
    sc._strata_shipped = True


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder for one intermediate table below the shared folder."""
    return f"{shared_dir(spark)}/strata/llm-{tag}-{uuid.uuid4().hex[:12]}"


def trim() -> None:
    """Give freed memory of a Python worker back to the machine.

    Workers live on from stage to stage; what malloc and Arrow keep for later use would
    add up with what other stages' workers keep.
    """
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if release:
        release(0)


_AT_WORK: list[str] = []
_TABLES: list = []


def enter(operator: str) -> None:
    """Called by an operator's task code: what another operator left in this worker goes.

    A worker keeps the tables of one operator (``kept``) from task to task, not of all
    that a pipeline has run in it.
    """
    if _AT_WORK != [operator]:
        for table in _TABLES:
            table.clear()
        _AT_WORK[:] = [operator]
        trim()


def kept(table):
    """Register a dict or list that an operator keeps in a worker."""
    _TABLES.append(table)
    return table


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, every
    executor can read the result, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(fn: Callable[..., pa.RecordBatch | None]) -> Callable:
    """``mapInArrow`` function from one that maps a batch to a batch (or None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return run


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of ``texts`` in one array, and the offsets of the texts in it."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    return np.frombuffer(raw, dtype=np.uint32), ends


def pieces(texts: list[str], overlap: int, block: int = BLOCK_CHARS) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Blocks of at most about ``block`` characters: (index of each piece's text, pieces).

    A text longer than a block is cut; neighbouring pieces share ``overlap``
    characters, so each substring of ``overlap + 1`` characters is in exactly one piece.
    """
    ids: list[int] = []
    own: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        start = 0
        while True:
            part = t if not start and len(t) <= block else t[start : start + block]
            if size and size + len(part) > block:
                yield np.array(ids), own
                ids, own, size = [], [], 0
            ids.append(i)
            own.append(part)
            size += len(part)
            if start + block >= len(t):
                break
            start += block - overlap
    if own:
        yield np.array(ids), own


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values by a sort, which is quick for values that are nearly in order."""
    values = np.sort(values, kind="stable")
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values[start:end]`` for sorted, disjoint segments; 0 for empty ones."""
    out = np.zeros((len(starts), *values.shape[1:]), dtype=np.float64)
    full = np.flatnonzero(ends > starts)
    if len(full):
        edge = np.column_stack((starts[full], ends[full])).ravel()
        if edge[-1] == len(values):
            edge = edge[:-1]
        out[full] = np.add.reduceat(values, edge, axis=0, dtype=np.float64)[::2]
    return out


def fold(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def window_least(values: np.ndarray, n: int) -> np.ndarray:
    """Least of each run of ``n`` values, by doubling."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


#: bytes that separate words: ASCII blanks and controls; with punctuation
_BLANKS = np.zeros(256, dtype=bool)
_BLANKS[:33] = True
_MARKS = _BLANKS.copy()
for _lo, _hi in ((33, 48), (58, 65), (91, 97), (123, 128)):
    _MARKS[_lo:_hi] = True
_LONGEST = 4096
_POWERS = (np.random.default_rng(11).integers(1, 1 << 63, _LONGEST, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def word_hashes(
    texts: list[str], marks: bool = False, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """64-bit hashes of the words of all texts, each text's offsets, hashes of word prefixes.

    Words are those of ``str.split``; with ``marks`` ASCII punctuation separates too.
    ``prefixes`` asks for hashes of each word's first so many bytes. All texts are
    handled at once, on their UTF-8 bytes.
    """
    none = np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), [np.zeros(0, np.uint64) for _ in prefixes]
    flat = [t if t.isascii() else " ".join(t.split()) for t in texts]
    data = [t.encode("utf-8", "surrogatepass") for t in flat]
    raw = np.frombuffer(b" ".join([*data, b""]), dtype=np.uint8)
    blank = (_MARKS if marks else _BLANKS)[raw]
    begins = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(begins):
        return none
    lens = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1]))) - begins
    firsts = np.cumsum(lens) - lens
    letters = int(lens.sum())
    small = np.int32 if letters < 1 << 31 else np.int64
    at = np.arange(letters, dtype=small) - np.repeat(firsts.astype(small), lens)
    # a multiplier for each place, and a second mix for places beyond the table
    if lens.max() <= _LONGEST:
        value = _POWERS[at]
    else:
        value = _POWERS[at % _LONGEST] + fold((at // _LONGEST).astype(np.uint64)) * np.uint64(2)
    value *= raw[~blank] + np.uint64(1)
    words = fold(np.add.reduceat(value, firsts) + lens.astype(np.uint64))
    heads = [fold(np.add.reduceat(np.where(at < p, value, np.uint64(0)), firsts) + np.uint64((1 << 40) + p)) for p in prefixes]
    ends = np.cumsum([0, *(len(d) + 1 for d in data)])
    return words, np.searchsorted(begins, ends), heads
