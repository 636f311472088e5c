"""BPE encoding and decoding with a public tokenizer file (operator 7).

Encoder: every vocabulary match inside a word comes from one Aho-Corasick pass; the
encoder walks the word with the longest match at each place, steps back to a shorter
match where a neighbouring pair could not stand next to each other in the merge
order (the pair-compatibility table), and remembers dead places, so a word takes
linear time and the ids equal those of applying the merges in rank order.
Decoder: one byte table of all token texts and an offset table; decoding is a gather.

Words repeat, so each worker keeps a bounded table of chunks already encoded.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import enter, kept, trim

#: white space of the tokenizer's ``\s`` (Unicode White_Space), fixed values
_BLANK = "\t-\r \u0085   -     　"
_RUN = regex.compile(f"[{_BLANK}]+")
_CONTROL = re.compile("[\x1c-\x1f]")
#: remembered chunks of a worker, at most
WORD_TABLE = 300_000
#: characters of a text that are encoded at once, cut at white space
PIECE = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, other = [""] * 256, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b] = chr(other)
            other += 1
    return letters


class Codec:
    """Encoder and decoder of one tokenizer file with word ends and byte letters."""

    def __init__(self, path: str):
        with open(vocabulary(path), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"[^\s", f"[^{_BLANK}"))
        self._letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> rank of its merge, left part, right part
        for k, (a, b) in enumerate(pairs):
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank.setdefault((left, right), k)
            self.made.setdefault(whole, (k, left, right))
        self._tail = ""  # one letter in the place of the word-end mark
        self._match = ahocorasick.Automaton()
        keys = {self._key(token): i for token, i in self.vocab.items()}
        for key, i in keys.items():
            self._match.add_word(key, (len(key), i))
        self._match.make_automaton()
        # token -> (size, token) of the longest other token that it begins with
        self._shorter: dict[int, tuple[int, int]] = {}
        for key, i in keys.items():
            for n in range(len(key) - 1, 0, -1):
                if (less := keys.get(key[:n])) is not None:
                    self._shorter[i] = (n, less)
                    break
        self._fits: dict[tuple[int, int], bool] = {}
        self._table = _WordTable(self)
        by_id = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        size = max(by_id) + 1
        shown = [(by_id.get(i, "") + " ").encode() for i in range(size)]
        self.offsets = np.concatenate(([0], np.cumsum([len(x) for x in shown])))
        self.bytes = np.frombuffer(b"".join(shown), dtype=np.uint8)

    def _key(self, token: str) -> str:
        return token[: -len(self.suffix)] + self._tail if token.endswith(self.suffix) and token != self.suffix else token

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` can be neighbours in an encoding.

        Undo the merges that touch the seam, the latest first. If the two pieces at
        the seam have a merge that comes before the one just undone, the rank order
        would have joined them across the seam.
        """
        key = (left, right)
        known = self._fits.get(key)
        if known is not None:
            return known
        made, rank = self.made, self.rank
        before = len(rank)
        # a merge of equal rank at the seam goes to the pair further left
        ok = True
        from_left = False
        while True:
            joined = rank.get((left, right))
            if joined is not None and (joined < before or (joined == before and not from_left)):
                ok = False
                break
            x, y = made.get(left), made.get(right)
            if x is None and y is None:
                break
            if y is None or (x is not None and x[0] > y[0]):
                before, left, from_left = x[0], x[2], True
            else:
                before, right, from_left = y[0], y[1], False
        if len(self._fits) > 2_000_000:
            self._fits.clear()
        self._fits[key] = ok
        return ok

    def word(self, word: str) -> list[int]:
        """Ids of one word by longest matches and steps back."""
        letters = word if word.isascii() and word.isprintable() else "".join([self._letters[b] for b in word.encode()])
        text = letters + self._tail
        # longest match after longest match: often no pair objects
        matches = [found for _, found in self._match.iter_long(text)]
        out: list[int] = []
        known, left = self._fits, -1
        for _, token in matches:
            if left >= 0:
                ok = known.get((left, token))
                if not (self.fits(left, token) if ok is None else ok):
                    return self._with_steps_back(text)
            out.append(token)
            left = token
        if not out or sum([n for n, _ in matches]) != len(text):
            return self._with_steps_back(text)
        return out

    def _longest(self, text: str, at: int) -> tuple[int, int]:
        for end, found in self._match.iter_long(text, at):
            if end + 1 - found[0] == at:
                return found
            break
        raise ValueError("the vocabulary has no letter for a byte")

    def _with_steps_back(self, text: str) -> list[int]:
        n = len(text)
        if text[-1] != self._tail:
            raise ValueError("a word without its end mark")
        last = n - 1  # the end mark alone is no token
        shorter, known = self._shorter, self._fits
        out: list[int] = []
        chosen: list[tuple[int, int, int]] = []  # start, size and token
        dead = {last}
        at = 0
        found = self._longest(text, 0)
        while True:
            left = out[-1] if out else -1
            while found is not None:
                size, token = found
                if at + size not in dead:
                    if left < 0:
                        break
                    ok = known.get((left, token))
                    if self.fits(left, token) if ok is None else ok:
                        break
                found = shorter.get(token)
            if found is not None:
                out.append(token)
                chosen.append((at, size, token))
                at += size
                if at == n:
                    return out
                found = self._longest(text, at)
            elif not out:
                raise ValueError("the vocabulary has no letter for a byte")
            else:
                dead.add(at)
                at, _, token = chosen.pop()
                out.pop()
                found = shorter.get(token)

    def parts(self, text: str) -> Iterator[str]:
        """Pieces of a text that encode on their own: cut after white space."""
        start = 0
        while len(text) - start > PIECE:
            cut = start + PIECE
            found = _RUN.search(text, cut)
            while found and found.end() < len(text) and unicodedata.combining(text[found.end()]):
                found = _RUN.search(text, found.end())
            if not found:
                break
            yield text[start : found.end()]
            start = found.end()
        yield text[start:]

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")  # letter by letter: no final form
        text = text.lower()
        # str.split also cuts at four control characters that are no white space here
        chunks = _RUN.split(text) if _CONTROL.search(text) else text.split()
        return b"".join(map(self._table.__getitem__, chunks))

    def encode_bytes(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, piece by piece."""
        for part in self.parts(text):
            last = 0
            for m in self._specials.finditer(part) if self._specials else ():
                yield self._plain(part[last : m.start()])
                yield self.special[m.group()].to_bytes(4, "little")
                last = m.end()
            yield self._plain(part[last:] if last else part)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.encode_bytes(text)), dtype="<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Token texts with one blank after each."""
        if not len(ids):
            return b""
        begins = self.offsets[ids]
        sizes = self.offsets[ids.astype(np.int64) + 1] - begins
        shift = begins - (np.cumsum(sizes) - sizes)
        return self.bytes[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, dtype=np.int64))[:-1].decode()


class _WordTable(dict):
    """Ids of the blank-free chunks of lower-case text met lately, in two generations."""

    def __init__(self, codec: Codec):
        super().__init__()
        self._codec = codec
        self._older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        out = self._older.get(chunk)
        if out is None:
            codec = self._codec
            if chunk.isalpha():
                ids = codec.word(chunk)
            else:
                ids = [i for word in codec.words.findall(chunk) for i in codec.word(word)]
            out = struct.pack(f"<{len(ids)}I", *ids)
            if len(chunk) > 100:
                return out
        if len(self) >= WORD_TABLE // 2:
            self._older = dict(self)
            self.clear()
        self[chunk] = out
        return out


def vocabulary(name: str) -> str:
    """Place of a tokenizer file on this machine: a path, or the name of a public one,
    which the package of the public files looks up on each executor."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


#: the tokenizer that the queries use, by name; each executor looks it up
TOKENIZER = "word_bpe_49k.json"


def tokenizer_file(name: str = TOKENIZER) -> str:
    """Where a tokenizer file is on this machine."""
    return vocabulary(name)


_CODECS: dict[str, Codec] = kept({})


def codec(path: str) -> Codec:
    """One codec a worker and file."""
    enter("bpe")
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids, n_tokens): the token ids of every whole text.

    A null text counts as empty: no ids. Rows with equal or null ids are encoded each
    on its own; other columns are not read, so their names do not matter. With ``decoded``
    the ids are decoded again, as ``decode_documents`` does, and the SHA-256 of the text
    that they stand for comes along (decoded_sha256).
    """
    source = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    names = [id_col, "ids", "n_tokens", *(["decoded_sha256"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids = [coder.encode(t or "").astype(np.int32) for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())]
                if decoded:
                    columns.append(pa.array([hashlib.sha256(coder.decode(x.astype(np.int64)).encode()).hexdigest() for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        trim()

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, n_tokens bigint" + (", decoded_sha256 string" if decoded else ""))


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def decode_documents(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text): the texts of the token ids; null ids count as none."""
    source = encoded.select(encoded[id_col].alias("key"), encoded["ids"].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in batches:
            for part in slices(batch):
                texts = [coder.decode(np.array(x or [], dtype=np.int64)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    Encoding and decoding go through the same codec as ``encode_documents`` and
    ``decode_documents``, piece by piece, so a very long text is never held as one
    list of ids. A null text counts as empty: 0 tokens and the digests of no bytes.
    """
    source = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids, shown, n, held = hashlib.sha256(), hashlib.sha256(), 0, b""
                for part in coder.encode_bytes(text.as_py() or ""):
                    ids.update(part)
                    n += len(part) // 4
                    if part:
                        if held:
                            shown.update(held)
                        held = coder.decode_bytes(np.frombuffer(part, dtype="<u4"))
                shown.update(held[:-1])  # no blank after the last token
                counts.append(n)
                ids_sha.append(ids.hexdigest())
                text_sha.append(shown.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
