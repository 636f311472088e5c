"""Alignment of two tokenizers' tokens, with corpus-wide pair counts (operator 13).

Both tokenizers' tokens cut the same bytes. Where both cut, a group ends; a token of
A and a token of B are linked if their bytes overlap. For each link it is asked how often
its pair of ids is linked in the whole corpus, and whether that is the most of its B id.

* Encoding. A text is cut into fragments before a blank or line end that follows a
  letter or mark, and before a mark that follows a letter, where neither tokenizer can
  join what stands on both sides (``Aligner`` looks this up in its vocabularies). Fragments repeat, so each worker encodes and
  aligns the distinct ones and remembers a bounded number of them.
* Spilling. A block of texts gives records (pair, document, times), summed, sorted by
  pair with the B side as the major part, cut by the B id's last digits (the radix) and
  packed into zstd runs in a table in the shared folder.
* Counting. The heads of the runs (pairs and their sums) are merged by a heap, bucket by
  bucket (``runs``). The pairs of a B id come one after another, so its highest count
  is known when the next one begins.
* Back to the documents. Each bucket's counts, whose number is bounded by the two
  vocabularies, are read once by every slice of its runs, and a run's contributions are
  summed by document. A hot pair is one entry a run, and a hot bucket has more slices.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import runs
from strata.llm.bpe import byte_letters, vocabulary
from strata.llm.common import enter, kept, trim, written

#: UTF-8 bytes of texts handled at once
BLOCK_BYTES = 4 << 20
#: fragments that a worker remembers, at most, and the longest of them in bytes
REMEMBERED, LONGEST = 500_000, 64
#: buckets of B ids, and bytes of runs that one slice of a bucket reads, about
BUCKETS, SLICE_BYTES = 64, 64 << 20
SCHEMA = ("batch bigint, ord int, doc_id {}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
          "bucket int, first bigint, n int, keys binary, counts binary, size int, fan binary, docs binary, times binary")
_COLUMNS = [c.split(" ")[0] for c in SCHEMA.split(", ")]


class Aligner:
    """Tokens, groups and links of fragments."""

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(vocabulary(file_a))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(file_b))
        byte = {c: i for i, c in enumerate(byte_letters())}
        tokens = self.a.get_vocab(with_added_tokens=False)
        self.n_a = max(tokens.values()) + 1
        shown = [b""] * self.n_a
        for token, i in tokens.items():
            shown[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else b""
        self.bytes_a, self.lens_a = _table(shown)
        self.n_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        shown = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes_b, self.lens_b = _table(shown)
        #: the numbers in decimal, each with a place for what follows it
        digits = [b"%d " % i for i in range(max(self.n_a, self.n_b))]
        self.digits, self.n_digits = _table(digits)
        self.at_digits = np.cumsum(self.n_digits) - self.n_digits
        #: what a fragment may begin with: blanks and line ends that no piece has after
        #: anything else, and after a letter also marks that no piece has after a letter
        shown = [p.replace("▁", " ") for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        pairs = {p[i : i + 2] for p in shown for i in range(len(p) - 1)}
        self.cuts = [ord(c) for c in " \n" if not any(x[1] == c and not x[0].isspace() for x in pairs)]
        self.marks = [ord(c) for c in ".,;:!?" if not any(x[1] == c and x[0].isalpha() for x in pairs)]
        #: B encodes a fragment without a blank in front behind a line end, which no piece has
        self.apart = "\n" if not any("\n" in p for p in shown) else None
        self.behind = len(self.b.encode("\n"))
        if self.apart is None:
            self.cuts, self.marks = [c for c in self.cuts if c == 32], []
        self.known: dict[bytes, tuple] = {}
        self.older: dict[bytes, tuple] = {}
        # B ids in the order of their buckets: the last digits first
        self.per = -(-self.n_b // BUCKETS)

    def fragments(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where the fragments of ``raw`` begin; ``starts``: where its texts begin."""
        begin = np.zeros(len(raw), dtype=bool)
        begin[starts] = True
        kind = np.zeros(256, dtype=np.uint8)
        kind[self.marks] = 1
        kind[self.cuts] = 2
        at = np.flatnonzero(kind[raw])
        at = at[at > 1]
        before, lead = raw[at - 1], raw[at - 2]
        # after a letter from U+00C0 to U+027F (two bytes), or printable ASCII, never after white space
        latin = (before >= 128) & (before < 192) & (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7)))
        small = before | 32
        letter = latin | ((before < 128) & (small >= 97) & (small <= 122))
        sure = letter | ((kind[raw[at]] == 2) & (before > 32) & (before < 127))
        begin[at[sure]] = True
        return np.flatnonzero(begin)

    def look_up(self, parts: list[bytes]) -> list[tuple]:
        """(n_a, n_b, n_groups, links, groups) of each fragment; n_a is -1 where a
        tokenizer's bytes are not the fragment's."""
        known, older = self.known, self.older
        new = [p for p in parts if p not in known and p not in older]
        fresh: dict[bytes, tuple] = {}
        for i in range(0, len(new), 20_000):
            some = new[i : i + 20_000]
            fresh.update(zip(some, self.align(some)))
        out = [known.get(p) or older.get(p) or fresh[p] for p in parts]
        if len(known) > REMEMBERED // 2:  # what has not been asked for since the last time goes
            self.older, self.known = known, {}
            known = self.known
        known.update((p, x) for p, x in zip(parts, out) if len(p) <= LONGEST)
        return out

    def align(self, parts: list[bytes]) -> list[tuple]:
        texts = [p.decode() for p in parts]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts a blank in front of what it encodes: that of the fragment, or one before a line end
        asked = [t[1:] if t[0] == " " and len(t) > 1 else (self.apart or "") + t for t in texts]
        ids_b = self.b.encode(asked, num_threads=1)
        for i, t in enumerate(texts):
            if t[0] != " " or len(t) == 1:
                ids_b[i] = ids_b[i][self.behind :] if self.apart else [0]
        out: list[tuple] = [(-1, 0, 0, b"", b"")] * len(parts)
        at = np.flatnonzero(self._same(parts, ids_a, self.bytes_a, self.lens_a) & self._same(parts, ids_b, self.bytes_b, self.lens_b)).tolist()
        if not at:
            return out
        na, a = _flat([ids_a[i] for i in at])
        nb, b = _flat([ids_b[i] for i in at])
        ends_a, ends_b = np.cumsum(self.lens_a[a]), np.cumsum(self.lens_b[b])
        every = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
        again = every[1:] == every[:-1]
        both, seams = every[1:][again], every[np.concatenate(([True], ~again))]  # a stretch between two seams is one link
        links = self.key(a[np.searchsorted(ends_a, seams)], b[np.searchsorted(ends_b, seams)]).tobytes()
        ends = np.cumsum([len(parts[i]) for i in at])
        link_ends, group_ends = np.searchsorted(seams, ends, "right").tolist(), np.searchsorted(both, ends, "right").tolist()
        shown, places = self._shown(a, b, ends_a, ends_b, both)
        text_ends = places[np.cumsum(na + nb) - 1].tolist()
        start_link = start_group = start = 0
        for place, x, y, link, group, end in zip(at, na.tolist(), nb.tolist(), link_ends, group_ends, text_ends):
            out[place] = (x, y, group - start_group, links[8 * start_link : 8 * link], shown[start : end - 1])
            start_link, start_group, start = link, group, end
        return out

    def _shown(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, both: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups as text, a ``;`` after each, and where each token's part of it ends."""
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        upto_a, upto_b = np.searchsorted(ends_a, both, "right"), np.searchsorted(ends_b, both, "right")
        place_a = np.arange(len(a)) + np.concatenate(([0], upto_b))[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        ids = np.empty(len(a) + len(b), dtype=np.int64)
        after = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a[upto_a - 1]] = ord("|")
        after[place_b[upto_b - 1]] = ord(";")
        size = self.n_digits[ids]
        ends = np.cumsum(size)
        text = self.digits[np.arange(int(ends[-1])) + np.repeat(self.at_digits[ids] - (ends - size), size)]
        text[ends - 1] = after
        return text.tobytes(), ends

    @staticmethod
    def _same(parts: list[bytes], ids: list[list[int]], shown: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Whether the bytes of each fragment's tokens are the fragment's."""
        n, flat = _flat(ids)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        inside = (flat >= 0) & (flat < len(lens))
        flat = np.where(inside, flat, 0)
        sums = np.add.reduceat(np.append(np.where(inside, lens[flat], 1 << 40), 0), np.cumsum(n) - n) * (n > 0)
        ok = sums == size
        if not ok.any():
            return ok
        tokens = flat[np.repeat(ok, n)]
        starts = np.cumsum(lens) - lens
        width = lens[tokens]
        got = shown[np.arange(int(width.sum())) + np.repeat(starts[tokens] - (np.cumsum(width) - width), width)]
        want = np.frombuffer(b"".join([p for p, x in zip(parts, ok.tolist()) if x]), dtype=np.uint8)
        equal = np.add.reduceat((got != want).astype(np.int64), np.cumsum(size[ok]) - size[ok]) == 0
        ok[np.flatnonzero(ok)[~equal]] = False
        return ok

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of ids as numbers whose order is that of bucket, B id, A id."""
        return ((b % BUCKETS) * self.per + b // BUCKETS) * self.n_a + a

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        return keys // (self.n_a * self.per)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists, and their numbers in one array."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return n, np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))


def _table(shown: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(shown), dtype=np.uint8), np.array([len(s) for s in shown], dtype=np.int64)


_ALIGNERS: dict[tuple[str, str], Aligner] = kept({})


def aligner(file_a: str, file_b: str) -> Aligner:
    enter("alignment")
    if (file_a, file_b) not in _ALIGNERS:
        _ALIGNERS[file_a, file_b] = Aligner(file_a, file_b)
    return _ALIGNERS[file_a, file_b]


class Block:
    """Texts of about ``BLOCK_BYTES`` (or a part of a longer one), aligned."""

    def __init__(self, tool: Aligner, texts: list[bytes]):
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        begins = tool.fragments(raw, ends - [len(t) for t in texts])
        offsets = np.append(begins, len(raw)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        self.found = tool.look_up(parts.dictionary.to_pylist())
        self.part = parts.indices.to_numpy()
        self.edges = np.searchsorted(begins, ends)  # fragments up to the end of each text
        n_a, n_b, n_groups, links, self.shown = zip(*self.found)
        count = lambda x: np.fromiter(x, np.int64, len(self.found))
        n = [count(n_a), count(n_b), count(n_groups)]
        self.links = count(map(len, links)) // 8
        self.pairs = np.frombuffer(b"".join(links), dtype=np.int64)
        starts = np.concatenate(([0], self.edges[:-1]))
        sums = lambda x: np.add.reduceat(x[self.part], starts)
        self.bad = sums((n[0] < 0).astype(np.int64)) > 0
        self.numbers = [np.where(self.bad, 0, sums(x)) for x in (*n, self.links)]

    def digest(self, i: int, sha) -> None:
        """Add the groups of text ``i`` to a hash."""
        start = self.edges[i - 1] if i else 0
        shown = self.shown
        sha.update(b";".join([shown[p] for p in self.part[start : self.edges[i]].tolist()]))

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, text, times) in the order of pairs and texts; texts without tokens have none."""
        n_docs, n_parts = len(self.edges), len(self.found)
        doc = np.repeat(np.arange(n_docs), np.diff(self.edges, prepend=0))
        good = ~self.bad[doc]
        cell, times = np.unique(doc[good] * n_parts + self.part[good], return_counts=True)
        doc, part = cell // n_parts, cell % n_parts
        keys, rank = np.unique(self.pairs, return_inverse=True)
        ends = np.cumsum(self.links)
        size = self.links[part]
        at = np.arange(int(size.sum())) + np.repeat((ends - self.links)[part] - (np.cumsum(size) - size), size)
        cells, sums = runs.summed(rank[at] * n_docs + np.repeat(doc, size), np.repeat(times, size))
        return keys[cells // n_docs], cells % n_docs, sums


def run_rows(tool: Aligner, batch: int, n_docs: int, block: Block) -> Iterator[dict]:
    """The block's records as packed runs, a row for each bucket (or ``runs.BLOCK`` pairs)."""
    pair, doc, times = block.records()
    if not len(pair):
        return
    at = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    keys, totals, upto = pair[at], np.add.reduceat(times, at), np.append(at, len(pair))
    for bucket, i, j in runs.blocks(tool.bucket_of(keys), keys):
        inside = slice(upto[i], upto[j])
        yield {"batch": batch, "bucket": bucket, "first": int(keys[i]), "n": j - i, "keys": runs.pack_keys(keys[i:j]), "counts": runs.pack(totals[i:j]),
               "size": n_docs, "fan": runs.pack(np.diff(upto[i : j + 1])), "docs": runs.pack(doc[inside]), "times": runs.pack(times[inside])}


def encoded(docs: DataFrame, file_a: str, file_b: str, id_col: str, text_col: str) -> DataFrame:
    """One written table with a row for each document (``ord`` set) and the packed runs."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = SCHEMA.format(kind)
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    types = {"doc_id": id_type, "ord": pa.int32(), "bucket": pa.int32(), "n": pa.int32(), "size": pa.int32(), "groups_sha256": pa.string(),
             **{c: pa.binary() for c in ("keys", "counts", "fan", "docs", "times")}}
    arrow = pa.schema([(c, types.get(c, pa.int64())) for c in _COLUMNS])

    def rows(found: list[dict]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(found), 500):
            yield pa.RecordBatch.from_pylist(found[i : i + 500], schema=arrow)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                if size and size + len(data) > BLOCK_BYTES:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(data)
                size += len(data) + 1
        if ids:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(file_a, file_b)
        number = TaskContext.get().partitionId() << 28
        for ids, texts in blocks(batches):
            number += 1
            out = {"batch": number, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
            full = [i for i, t in enumerate(texts) if t]
            lines = [{**out, "ord": i, "doc_id": x} for i, x in enumerate(ids)]
            if len(texts) == 1 and len(texts[0]) > BLOCK_BYTES:
                yield from rows(long_text(tool, texts[0], lines[0]))
                continue
            if full:
                block = Block(tool, [b" " + texts[i] for i in full])
                numbers = [x.tolist() for x in block.numbers]
                for k, i in enumerate(full):
                    if not block.bad[k]:
                        sha = hashlib.sha256()
                        block.digest(k, sha)
                        lines[i] |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), (x[k] for x in numbers)), groups_sha256=sha.hexdigest())
                block_rows = run_rows(tool, number, len(ids), block)
                if len(full) < len(ids):  # texts of the block that have no bytes are not in it
                    block_rows = _renumbered(block_rows, np.array(full))
                yield from rows([*lines, *block_rows])
            else:
                yield from rows(lines)
        trim()

    source = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return written(source.mapInArrow(run, schema), "aligned")


def _renumbered(block_rows: Iterator[dict], places: np.ndarray) -> Iterator[dict]:
    for row in block_rows:
        yield row | {"docs": runs.pack(places[runs.unpack(row["docs"])])}


def long_text(tool: Aligner, text: bytes, line: dict) -> list[dict]:
    """The rows of one text beyond ``BLOCK_BYTES``: part by part, each ending with a
    fragment; first it is seen whether all parts have the text's bytes."""
    data = b" " + text
    begins = tool.fragments(np.frombuffer(data, dtype=np.uint8), np.zeros(1, dtype=np.int64))
    cuts = [0]
    for stop in begins.tolist():
        if stop - cuts[-1] >= BLOCK_BYTES:
            cuts.append(stop)
    parts = [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
    if any(Block(tool, [p]).bad[0] for p in parts):
        return [line]
    sha, out = hashlib.sha256(), []
    names = ("n_a", "n_b", "n_groups", "n_links")
    for k, part in enumerate(parts):
        block = Block(tool, [part])
        if k:
            sha.update(b";")
        block.digest(0, sha)
        line |= {c: line[c] + int(x[0]) for c, x in zip(names, block.numbers)}
        out += run_rows(tool, line["batch"], 1, block)
    line["groups_sha256"] = sha.hexdigest()
    return [line, *out]


def pair_counts(spilled: DataFrame, n_a: int, per: int, tasks: int) -> DataFrame:
    """(bucket, first, n, keys, counts, best): how often each pair of ids is linked, and
    whether that is the most of its B id."""
    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return keys // (n_a * per)

    def rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        side = keys // n_a
        at = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
        most = np.repeat(np.maximum.reduceat(counts, at), np.diff(np.append(at, len(keys))))
        out = [(b, int(keys[i]), j - i, runs.pack_keys(keys[i:j]), runs.pack(counts[i:j]), runs.pack((counts == most)[i:j].astype(np.int64)))
               for b, i, j in runs.blocks(bucket_of(keys), keys)]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["bucket", "first", "n", "keys", "counts", "best"])

    def emit(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for k, c in parts:
            keys, counts = np.concatenate((keys, k)), np.concatenate((counts, c))
            done = int(np.searchsorted(keys, keys[-1] // n_a * n_a))  # the last B id may have more to come
            if done:
                yield rows(keys[:done], counts[:done])
                keys, counts = keys[done:], counts[done:]
        if len(keys):
            yield rows(keys, counts)

    return runs.merged(spilled, tasks, emit, "bucket int, first bigint, n int, keys binary, counts binary, best binary", bucket_of)


def contributions(spilled: DataFrame, counted: DataFrame, tasks: int) -> DataFrame:
    """(batch, ord, n_best, count_sum) of every text with links."""
    largest = spilled.groupBy("bucket").agg(F.sum(F.octet_length("docs") + F.octet_length("times")).alias("bytes")).agg(F.max("bytes")).first()[0] or 0
    slices = max(1, -(-largest // SLICE_BYTES))
    runs_side = spilled.select("bucket", F.pmod(F.xxhash64("batch", "first"), F.lit(slices)).alias("slice"), F.lit(1).alias("side"), "first", "keys", "counts",
                               F.lit(None).cast("binary").alias("best"), "batch", "size", "fan", "docs", "times")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("batch", "bigint"), ("size", "int"), ("fan", "binary"), ("docs", "binary"), ("times", "binary"))]
    count_side = counted.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"), F.lit(0).alias("side"), "first", "keys", "counts", "best", *nothing)
    dealt = count_side.unionByName(runs_side).repartition(tasks, "bucket", "slice").sortWithinPartitions("bucket", "slice", "side", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, table = None, [], None
        for some in batches:
            out = []
            for row in some.to_pylist():
                keys = np.cumsum(runs.unpack(row["keys"])) + row["first"]
                if (row["bucket"], row["slice"]) != at:
                    at, parts, table = (row["bucket"], row["slice"]), [], None
                if not row["side"]:
                    parts.append((keys, runs.unpack(row["counts"]), runs.unpack(row["best"])))
                    continue
                if table is None:
                    table, parts = [np.concatenate(x) for x in zip(*parts)], []
                place = np.searchsorted(table[0], keys)
                fan, docs, times = (runs.unpack(row[c]) for c in ("fan", "docs", "times"))
                count, best = np.repeat(table[1][place], fan), np.repeat(table[2][place], fan)
                # sums of floats are exact below 2 ** 53: counts are summed in two halves
                part = lambda x: np.bincount(docs, x.astype(np.float64), row["size"]).astype(np.int64)  # noqa: B023, E731
                sums = part(times * (count & 0xFFFFFF)) + (part(times * (count >> 24)) << 24)
                out.append((row["batch"], runs.pack(part(times * best)), runs.pack(sums)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], names=["batch", "best", "sums"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def line(batch: int, best: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(best), batch)), pa.array(np.arange(len(best), dtype=np.int32)), pa.array(best), pa.array(sums)], names=["batch", "ord", "n_best", "count_sum"])

        at, best, sums = None, None, None
        for some in batches:
            for row in some.to_pylist():
                if row["batch"] != at:
                    if at is not None:
                        yield line(at, best, sums)
                    at, best, sums = row["batch"], runs.unpack(row["best"]), runs.unpack(row["sums"])
                else:
                    best, sums = best + runs.unpack(row["best"]), sums + runs.unpack(row["sums"])
        if at is not None:
            yield line(at, best, sums)

    by_batch = dealt.mapInArrow(run, "batch bigint, best binary, sums binary").repartition(tasks, "batch").sortWithinPartitions("batch")
    return by_batch.mapInArrow(add_up, "batch bigint, ord int, n_best bigint, count_sum bigint")


def align_documents(docs: DataFrame, file_a: str = "byte_bpe_50k.json", file_b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    Texts that are null, empty, or whose tokens' bytes differ from a blank and the text
    have no tokens: zeros and an empty digest; they take no part in the counts. Rows with
    equal or null ids are aligned each on its own, and each counts. Texts of any length
    are handled in parts of about ``BLOCK_BYTES`` that end with a fragment. An empty table
    gives an empty one. Other columns are not read, so their names do not matter.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tool = Aligner(file_a, file_b)  # the driver needs the sizes of the vocabularies only
    table = encoded(docs, file_a, file_b, id_col, text_col)
    spilled = table.where(F.col("bucket").isNotNull())
    counted = written(pair_counts(spilled, tool.n_a, tool.per, tasks), "pair-counts")
    sums = contributions(spilled, counted, tasks)
    lines = table.where(F.col("ord").isNotNull()).select("batch", "ord", F.col("doc_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return lines.join(sums, ["batch", "ord"], "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def counted_pairs(docs: DataFrame, file_a: str = "byte_bpe_50k.json", file_b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, links, best): every linked pair of ids, its links in the corpus, and whether
    they are the most of its B id (ties included)."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tool = Aligner(file_a, file_b)
    n_a, per = tool.n_a, tool.per
    spilled = encoded(docs, file_a, file_b, id_col, text_col).where(F.col("bucket").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for row in some.to_pylist():
                keys = np.cumsum(runs.unpack(row["keys"])) + row["first"]
                side = keys // n_a
                yield pa.RecordBatch.from_arrays([pa.array(keys % n_a), pa.array(side % per * BUCKETS + side // per), pa.array(runs.unpack(row["counts"])), pa.array(runs.unpack(row["best"]) > 0)], names=["a", "b", "links", "best"])

    return pair_counts(spilled, n_a, per, tasks).mapInArrow(run, "a bigint, b bigint, links bigint, best boolean")
