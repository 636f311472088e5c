import hashlib

import cases
import numpy as np
import pytest

from strata.llm import syncmers
from strata.llm.common import code_points, fold


def brute_anchors(text, p):
    """Closed syncmers straight from the definition, with the same hash of s-mers."""
    points = [ord(c) for c in text]
    inner = []
    for i in range(len(points) - p.s + 1):
        h = 0
        for c in points[i : i + p.s]:
            h = (h * 0x100000001B3 + c) & (2**64 - 1)
        inner.append(int(fold(np.array([h], dtype=np.uint64))[0]))
    out = []
    for i in range(len(points) - p.k + 1):
        own = inner[i : i + p.k - p.s + 1]
        if min(own) in (own[0], own[-1]):
            out.append(i)
    return out


def test_anchors_are_closed_syncmers():
    p = syncmers.Params()
    for text in (cases.prose(1, 60), "äöü " * 40, "x" * 50, "short", "a" * 16, "ab" * 8 + "\U0001f600" * 20):
        points, _ = code_points([text])
        assert syncmers.anchors(points, p)[0].tolist() == brute_anchors(text, p)


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    from strata.llm import common

    texts = [cases.prose(i, 50 + 300 * (i % 3)) for i in range(6)] + ["", "x", "y" * 15, "z" * 16]
    whole = syncmers.prints(texts, syncmers.Params())
    monkeypatch.setattr(common.pieces, "__defaults__", (101,))
    cut = syncmers.prints(texts, syncmers.Params())
    assert (whole.hashes == cut.hashes).all() and (whole.places == cut.places).all()
    alone = [syncmers.prints([t], syncmers.Params()).text()[0] for t in texts]
    assert alone == whole.text() and whole.text()[6] == ""


def test_likeness():
    p = syncmers.Params()
    a = cases.prose(1, 400)
    words = a.split()
    near = " ".join([*words[:200], "new", *words[201:]])
    moved = " ".join(words[200:] + words[:200])
    other = cases.prose(2, 400)
    f = syncmers.prints([a, a, near, moved, other, "", ""], p)
    at = lambda i, j: float(syncmers.likeness(syncmers._rows(f, [i]), syncmers._rows(f, [j]), p)[0])
    assert at(0, 1) == 1 and at(0, 2) > 0.9 and at(0, 4) < 0.05 and at(5, 6) == 1 and at(0, 5) == 0
    assert at(0, 3) < 0.3  # the same anchors at other places


@pytest.mark.parametrize("clash", [False, True])
def test_neighbours_of_awkward_rows(spark, clash):
    docs = cases.documents(spark, clash)
    got = syncmers.compare_neighbours(docs).collect()
    order = sorted(cases.rows(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for i, (key, text, *_) in enumerate(order):
        changed = syncmers.edited(text or "", order[(i + 1) % len(order)][1] or "")
        want.append((key is None, key or 0, len(text or ""), hashlib.sha256(changed.encode()).hexdigest()))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_many_chunks(spark):
    rows = [(i * 7 % 1009, cases.prose(i, i % 30)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ordered = syncmers.in_order(docs, "doc_id", "text", rows_per_chunk=37)
    assert ordered.where("NOT guest").count() == 1000 and ordered.select("chunk").distinct().count() > 15
    real = syncmers.in_order
    syncmers.in_order = lambda d, a, b: real(d, a, b, 37)
    try:
        got = {r["doc_id"]: r["edited_sha256"] for r in syncmers.compare_neighbours(docs).collect()}
    finally:
        syncmers.in_order = real
    order = sorted(rows, reverse=True)
    assert got == {k: hashlib.sha256(syncmers.edited(t, order[(i + 1) % 1000][1]).encode()).hexdigest() for i, (k, t) in enumerate(order)}


def test_one_row_and_none(spark):
    one = syncmers.compare_neighbours(spark.createDataFrame([(3, "abcdef" * 5)], "doc_id bigint, text string")).collect()
    assert [r["near_next"] for r in one] == [1.0]
    assert syncmers.compare_neighbours(cases.nothing(spark)).collect() == []
    assert syncmers.fingerprints(cases.documents(spark)).count() == len(cases.rows())


def brute_likeness(x, y, p):
    """Bins in line less those out of line; the longest chain by comparing all pairs."""
    a, b = syncmers.prints([x], p), syncmers.prints([y], p)
    used = ((a.places >= 0) | (b.places >= 0)).sum()
    pairs = sorted((int(o), int(q)) for g, h, o, q in zip(a.hashes[0], b.hashes[0], a.places[0], b.places[0]) if g == h and o >= 0 and q >= 0)
    shifts = [q - o for o, q in pairs]
    best: list[int] = []
    for i, (_, q) in enumerate(pairs):
        best.append(1 + max((best[j] for j in range(i) if pairs[j][1] <= q), default=0))
    close = not shifts or max(shifts) - min(shifts) <= max(p.least_drift, p.drift * max(len(x), len(y)))
    agreed = len(pairs) if close else max(best)
    return max(0, 2 * agreed - len(pairs)) / used if used else 1.0


def test_shifted_copies_are_alike():
    p = syncmers.Params()
    text = cases.prose(31, 160)[:1000]
    front = cases.prose(32, 60)[:200]
    pairs = [(text, front + text), (front + text, text), (text, text[250:]), (text, text), (text, cases.prose(33, 160)), ("", ""), ("", text), (text, text[:400] + front + text[400:]),
             (text * 3, cases.prose(34, 900) + text * 3), (text, text[500:] + text[:500]), (text, text[800:] + text[:800])]
    got = [float(syncmers.likeness(syncmers.prints([x], p), syncmers.prints([y], p), p)[0]) for x, y in pairs]
    assert got == [brute_likeness(x, y, p) for x, y in pairs]
    assert got[0] >= 0.7 and got[1] >= 0.7 and got[2] >= 0.6 and got[3] == 1 and got[4] <= 0.05 and got[5] == 1 and got[6] == 0 and got[7] >= 0.7
    assert got[9] < 0.2 < 0.4 < got[10] < 0.8  # changed places
    # many pairs at once give the same as one by one
    a, b = syncmers.prints([x for x, _ in pairs], p), syncmers.prints([y for _, y in pairs], p)
    assert syncmers.likeness(a, b, p).tolist() == got
