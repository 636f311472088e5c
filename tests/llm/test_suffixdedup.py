import hashlib
import random
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from strata.llm import suffixdedup
from strata.llm.induced import suffix_order


def brute(rows, length=50):
    """Removed bytes by a table of all strings of that length."""
    first = {}
    for key, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], key)
    out = []
    for key, text, *_ in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1) if key is not None else ():
            if first[b[i : i + length]] < key:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key is None, key or 0, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_rows(spark, clash):
    assert got(suffixdedup.cleaned(cases.documents(spark, clash))) == brute(cases.rows())


def test_random_texts_against_brute_force(spark):
    r = random.Random(3)
    passages = [cases.prose(s, 25) for s in range(8)]
    rows = []
    for i in range(120):
        parts = [cases.prose(1000 + i, r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 60)
            parts.append(p[a : a + r.randint(40, 130)])
            parts.append(cases.prose(5000 + r.randint(0, 10**6), r.randint(0, 5)))
        rows.append((r.randint(-5, 200), "".join(parts) if r.random() < 0.5 else " ".join(parts)))
    rows += [(500 + i, "ab" * r.randint(20, 200)) for i in range(6)] + [(600 + i, "é" * r.randint(20, 60)) for i in range(4)]
    rows = list({k: (k, t) for k, t in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(suffixdedup.cleaned(docs, suffixdedup.Params(part_bytes=3000, bucket_bytes=2000, memory=500))) == brute(rows)


def test_one_passage_in_a_third_of_all_documents(spark):
    passage = cases.prose(77, 30)
    rows = [(i, cases.prose(i + 100, 20) + (" " + passage if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(suffixdedup.cleaned(docs, suffixdedup.Params(part_bytes=2000))) == brute(rows)


def line_rows():
    """Short lines, mostly too short to go themselves, between different texts, and some parts of these texts again."""
    rows = []
    for size in (20, 30, 45, 49, 60):
        line = f"x{size} " + cases.prose(size, 30)[: size - 4]
        rows += [(len(rows) + i, f"{cases.prose(size * 1000 + i, 12)}{i:05d}{line}{i * 7919 % 99991:05d}{cases.prose(size * 2000 + i, 12)}") for i in range(400)]
    return rows + [(5000 + i, rows[7 * i][1][20:-20]) for i in range(200)]


def test_short_lines_between_different_texts(spark):
    docs = spark.createDataFrame(line_rows(), "doc_id bigint, text string")
    assert got(suffixdedup.cleaned(docs, suffixdedup.Params(part_bytes=20_000, bucket_bytes=4000, group=50))) == brute(line_rows())


def grouped(tables, column):
    table = pa.concat_tables(tables)
    return [table.filter(pc.equal(table.column(column), x)) for x in sorted(set(table.column(column).to_pylist()))]


def test_no_shard_has_all_surroundings_of_a_short_line():
    """The messages of the steps, dealt by hand."""
    p, buckets, rows = suffixdedup.Params(group=50), 64, line_rows()
    parts = [pa.table({"part": pa.array([k] * len(own), pa.int32()), "key": [i for i, _ in own], "text": [suffixdedup.pack(t.encode()) for _, t in own]}) for k, own in enumerate(rows[k::10] for k in range(10))]
    shape = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("shared", pa.binary()), ("hot", pa.binary()), ("strings", pa.binary()), ("key", pa.int64()), ("mark", pa.string())])

    def to(part, mail):
        rows = [r for t in mail for r in t.to_pylist() if r["part"] == part]
        return pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in shape})

    told = [suffixdedup.piece_answers(t, p) for t in grouped([suffixdedup.piece_messages(x, buckets, p) for x in parts], "bucket")]
    hot = [t.filter(pc.is_valid(t.column("hot"))) for t in told]
    asked = [suffixdedup.string_messages(x, to(k, hot), buckets, p) for k, x in enumerate(parts)]
    told += [suffixdedup.string_answers(t) for t in grouped(asked, "bucket")]
    shards = grouped([suffixdedup.stretch_messages(x, to(k, told), buckets, p) for k, x in enumerate(parts)], "shard")
    held = []
    for t in shards:
        own = {(q, s) for x, y in zip(t.column("stretches").to_pylist(), t.column("pieces").to_pylist(), strict=True)
               for s, q in zip(suffixdedup.unpack(x).split(b"\xff"), np.frombuffer(y, "<u4").tolist(), strict=True)}
        held.append(max(Counter(q for q, _ in own).values()))
    assert len(shards) > 50 and max(held) <= 100


def test_no_rows(spark):
    assert suffixdedup.cleaned(cases.nothing(spark)).collect() == []


@pytest.mark.parametrize("memory", [4, 10**6])
def test_induced_order_and_common_prefixes(memory):
    r = random.Random(9)
    for _ in range(250):
        letters = r.choice([b"ab", b"abc", b"abcdefgh", b"\xffab", b"a"])
        text = bytes(r.choice(letters) for _ in range(r.randint(1, 70))) + b"\0"
        cap = r.choice([3, 9, 50])
        order, common = suffix_order(np.frombuffer(text, np.uint8), cap, memory)
        assert sorted(order.tolist()) == list(range(len(text)))
        heads = [text[i : i + cap] for i in order]
        assert heads == sorted(heads)
        for a, b, n in zip(heads, heads[1:], common[1:].tolist(), strict=False):
            same = 0
            while same < min(len(a), len(b)) and a[same] == b[same]:
                same += 1
            assert n == same


def test_whole_characters(spark):
    df = spark.createDataFrame([(bytearray("aé".encode()[:-1]),), (bytearray(b""),)], "b binary")
    assert [r["t"] for r in suffixdedup.whole_characters(df, "b", "t").collect()] == ["a", ""]


def test_kept_as_text_equals_the_kept_bytes(spark):
    docs = cases.documents(spark)
    own = suffixdedup.whole_characters(suffixdedup.cleaned(docs), "kept", "kept").collect()
    assert sorted(map(str, own)) == sorted(str(r) for r in suffixdedup.cleaned(docs, as_text=True).collect())


@pytest.mark.parametrize("alike", [False, True])
def test_equal_spans(monkeypatch, alike):
    """Also if hashes of different spans meet."""
    if alike:
        monkeypatch.setattr(suffixdedup, "short_hash", lambda raw, begin, end: (end - begin).astype(np.uint64) // np.uint64(3))
    r = random.Random(4)
    raw = bytes(r.choice(b"ab") for _ in range(900))
    begin = np.array([r.randint(0, 40) * 20 for _ in range(700)])
    end = begin + np.array([r.randint(8, 30) for _ in begin])
    which, first = suffixdedup.same_spans(np.frombuffer(raw, np.uint8), begin, end)
    spans = [raw[b:e] for b, e in zip(begin, end, strict=True)]
    assert sorted(spans[i] for i in first) == sorted(set(spans))
    assert all(spans[first[w]] == x for w, x in zip(which, spans, strict=True))


def test_runs_that_touch_are_one():
    r = random.Random(6)
    runs = [(r.randint(0, 4), b := r.randint(0, 300), b + r.randint(1, 20)) for _ in range(60)]
    row, begin, end = (x.tolist() for x in suffixdedup.merged(*(np.array(x) for x in zip(*runs, strict=True))))
    marked = {(i, k) for i, b, e in runs for k in range(b, e)}
    assert {(i, k) for i, b, e in zip(row, begin, end, strict=True) for k in range(b, e)} == marked
    assert all((i, e) not in marked for i, e in zip(row, end, strict=True)) and len(row) == sum((i, k - 1) not in marked for i, k in marked)


def test_a_part_whose_rows_come_in_another_order_at_each_step():
    """Blocks of several executors arrive as they come: no step may count on the order of another one."""
    r, p, buckets = random.Random(8), suffixdedup.Params(), 4
    passage = cases.prose(5, 20)
    rows = [(i % 45 if i < 60 else None, cases.prose(300 + i, 5 + i % 7) + (passage if i % 3 else "")) for i in range(64)]
    rows += [(90, rows[4][1]), (2, rows[4][1]), (70, None), (71, "")]
    texts = [(k, suffixdedup._to_text(t)) for k, t in rows]

    def part():
        mixed = r.sample(texts, len(texts))
        return pa.table({
            "part": pa.array([0] * len(mixed), pa.int32()), "key": pa.array([k for k, _ in mixed], pa.int64()),
            "text": pa.array([suffixdedup.pack(t) for _, t in mixed], pa.binary())})

    def by(table, column):
        return [table.filter(pc.equal(table.column(column), v)) for v in sorted(set(table.column(column).to_pylist()))]

    told = pa.concat_tables([suffixdedup.piece_answers(t, p) for t in by(suffixdedup.piece_messages(part(), buckets, p), "bucket")])
    n = told.num_rows
    mail = told.append_column("strings", pa.nulls(n, pa.binary())).append_column("key", pa.nulls(n, pa.int64())).append_column("mark", pa.nulls(n, pa.string()))
    mark = pa.table({"key": pa.array([k for k, t in texts if t == texts[4][1] and k > 2], pa.int64())})
    mark = mark.append_column("mark", pa.array([hashlib.md5(texts[4][1]).hexdigest()] * mark.num_rows))
    mail = pa.concat_tables([mail, mark], promote_options="default")
    sent = suffixdedup.sent_messages(part(), mail, buckets, p)
    answers = pa.concat_tables([suffixdedup.shard_answers(t, p) for t in by(sent, "shard")])
    left = part()
    left = getattr(suffixdedup, "in_order", lambda t: t)(left)
    own, runs = suffixdedup.removed(left, answers, p)
    out = []
    for key, t, spans in zip(left.column("key").to_pylist(), own, runs, strict=True):
        kept = bytes(x for i, x in enumerate(t) if not any(a <= i < b for a, b in spans))
        out.append((key is None, key or 0, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    assert sorted(out) == brute(rows)


def test_a_text_under_two_ids_of_which_one_is_another_rows_too(spark):
    text = cases.prose(41, 30)
    rows = [(4, text), (3, text), (4, text + " and more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert got(suffixdedup.cleaned(docs)) == brute(rows)
