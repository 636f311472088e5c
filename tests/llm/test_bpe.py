import hashlib
import random
import struct

import cases
import pytest
from tokenizers import Tokenizer

from strata.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.tokenizer_file())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.tokenizer_file())


def odd_texts():
    r = random.Random(4)
    out = ["", "  ", "it's I'LL we've", "a\x1cb\x85c", "İstanbul ΟΔΟΣ", "é ́x", "<|endoftext|>a<|startoftext|>", "﻿x ﬁ", "aaaaaaaaaaaaaaaaaaaa", "123 4五Ⅷ", "!!!??? ...a\x7f"]
    out += ["".join(r.choice("abcdeilnorst") for _ in range(r.randint(1, 60))) for _ in range(500)]
    ranges = [(32, 126), (160, 0x24F), (0x370, 0x52F), (0x4E00, 0x4FFF), (0x1F600, 0x1F64F)]
    out += ["".join(chr(r.randint(*r.choice(ranges))) for _ in range(120)) for _ in range(100)]
    return out


def test_ids_and_texts_are_the_librarys(codec, library):
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_in_pieces(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    text = cases.prose(1, 300) + " ́ e ́" + "y" * 200 + " <|endoftext|> end"
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_bounded_word_table(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_TABLE", 20)
    small = bpe.Codec(bpe.tokenizer_file())
    text = cases.prose(8, 400) * 2
    assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(small._table) + len(small._table._older) <= 20


@pytest.mark.parametrize("clash", [False, True])
def test_documents(spark, library, clash):
    docs = cases.documents(spark, clash)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip_digests(docs, bpe.tokenizer_file()).collect())
    want = []
    for key, text, *_ in cases.rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        want.append((key is None, key or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()))
    assert got == sorted(want)
    encoded = bpe.encode_documents(docs, bpe.tokenizer_file())
    assert encoded.columns == ["doc_id", "ids", "n_tokens"] and encoded.count() == len(want)
    texts = {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded, bpe.tokenizer_file()).collect()}
    assert texts[6] == library.decode(library.encode("one", add_special_tokens=False).ids, skip_special_tokens=False)


def test_no_rows(spark):
    assert bpe.round_trip_digests(cases.nothing(spark), bpe.tokenizer_file()).collect() == []


def test_encoding_with_the_decoded_digest(spark):
    docs = cases.documents(spark)
    plain = bpe.encode_documents(docs, bpe.TOKENIZER)
    both = bpe.encode_documents(docs, bpe.TOKENIZER, decoded=True)
    texts = bpe.decode_documents(plain, bpe.TOKENIZER)
    want = sorted((str(r.doc_id), hashlib.sha256(r.text.encode()).hexdigest()) for r in texts.collect())
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in both.collect()) == want
    assert sorted(map(str, both.drop("decoded_sha256").collect())) == sorted(map(str, plain.collect()))
