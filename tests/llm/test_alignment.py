import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import alignment
from strata.llm.bpe import byte_letters
from strata.llm.common import ship
from tests.llm import cases

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BYTE = {c: i for i, c in enumerate(byte_letters())}


def tokens(text):
    """Whole texts by the libraries: [(id, first byte, last byte + 1)] of A and B, or none."""
    if not text:
        return None
    whole = (" " + text).encode()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    shown_a = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    shown_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(shown_a) != whole or b"".join(shown_b) != whole:
        return None
    out = []
    for ids, shown in ((a, shown_a), (b, shown_b)):
        ends = np.cumsum([len(s) for s in shown]).tolist()
        out.append([(i, e - len(s), e) for i, s, e in zip(ids, shown, ends)])
    return out


def brute(rows):
    """rows: (doc_id, text)."""
    links, out = {}, []
    pairs = Counter()
    for k, (_, text) in enumerate(rows):
        found = tokens(text)
        links[k] = []
        if found:
            a, b = found
            j = 0
            for i, s, e in a:  # ranges ascend on both sides
                while b[j][2] <= s:
                    j += 1
                m = j
                while m < len(b) and b[m][1] < e:
                    links[k].append((i, b[m][0]))
                    m += 1
        pairs.update(links[k])
    most = defaultdict(int)
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    for k, (doc, text) in enumerate(rows):
        found = tokens(text)
        if not found:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = found
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        group = {e: k for k, e in enumerate(both)}
        sides = []
        for side in (a, b):
            at, lists = 0, [[] for _ in both]
            for i, _, e in side:
                lists[at].append(str(i))
                at += e in group
            sides.append(lists)
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides)]
        out.append((doc, len(a), len(b), len(both), len(links[k]), sum(pairs[p] == most[p[1]] for p in links[k]), sum(pairs[p] for p in links[k]),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(map(str, out)), pairs, most


def got(docs):
    ship(docs.sparkSession)
    return sorted(str(tuple(r)) for r in alignment.align_documents(docs).collect())


def odd(seed, n):
    r = random.Random(seed)
    some = ["a", "Hello", "don't", "x=1;", ";\r", "\r\n", "\n", " ", "  ", "\t", " ", "　", "é", "ß", "ﬁ", "́", "日本", "\U0001f600", "\x00", "\x1c", "​", "}\r", "()", "<|endoftext|>", "<s>", "<0x41>", "12", "'s", "naïve", "Ω", "ʼ", "\u0085", " "]
    return ["".join(r.choice(some) + r.choice(["", " ", " ", "\n"]) for _ in range(r.randint(1, 40))) for _ in range(n)]


def test_fragments_give_the_tokens_of_whole_texts():
    tool = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    for text in odd(1, 4000) + [" ", "  ", "\n", "a ", "a  ", "a \n", " a", "é x", "é\nx", "▁", "a▁b c"]:
        data = (" " + text).encode()
        begins = tool.fragments(np.frombuffer(data, np.uint8), np.zeros(1, np.int64)).tolist()
        parts = [data[i:j] for i, j in zip(begins, [*begins[1:], len(data)])]
        found = [tool.look_up([p])[0] for p in parts]
        want = tokens(text)
        assert (want is None) == any(f[0] < 0 for f in found), repr(text)
        if want:
            assert sum(f[0] for f in found) == len(want[0]) and sum(f[1] for f in found) == len(want[1])
            shown = b";".join(f[4] for f in found).decode()
            groups = [g.split("|") for g in shown.split(";")]
            assert [int(i) for g in groups for i in g[0].split(",")] == [i for i, _, _ in want[0]], repr(text)
            assert [int(i) for g in groups for i in g[1].split(",")] == [i for i, _, _ in want[1]], repr(text)


def test_equals_brute_force(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(odd(2, 150))] + [(1000 + i, "the same text again") for i in range(40)] + [(None, None), (7, ""), (7, "a▁b"), (7, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, pairs, most = brute(rows)
    assert got(docs) == want
    counted = {(r.a, r.b): (r.links, r.best) for r in alignment.counted_pairs(docs).collect()}
    assert counted == {p: (n, n == most[p[1]]) for p, n in pairs.items()}


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in cases.rows()]
    want = brute(rows)[0]
    assert got(cases.documents(spark)) == want
    assert got(cases.documents(spark, clash=True)) == want
    assert got(cases.nothing(spark)) == []


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    tool = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    line = {"batch": 1, "ord": 0, "doc_id": 5, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
    text = cases.prose(9, 400)
    out = alignment.long_text(tool, text.encode(), dict(line))
    want = brute([(5, text)])[0][0]
    assert str((5, out[0]["n_a"], out[0]["n_b"], out[0]["n_groups"], out[0]["n_links"])) [:-1] in want and out[0]["groups_sha256"] in want
    assert len(out) > alignment.BUCKETS
    assert alignment.long_text(tool, (text + " ▁").encode(), dict(line)) == [line]


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_equals_brute_force(spark, sf):
    from strata.llm.queries import op13_alignment
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = op13_alignment(spark, f"/root/testdata/sf{sf}")
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(str(tuple(r)) for r in df.collect()) == brute(rows)[0]
