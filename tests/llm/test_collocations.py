import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from strata.llm import collocations as co
from strata.llm import oracles, runs
from strata.llm.common import ship
from tests.llm import cases


def brute(rows, p):
    """rows: (text, lang)."""
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, p.longest + 1):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    cand = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= p.least}
    out = {}
    for (lang, w), a in cand.items():
        score, _, l, r = min((p.scale * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
        over = max((b for (m, v), b in cand.items() if m == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))), default=0)
        if over * 100 < p.covered * a:
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, t.decode(), -a, l, r, sizes[lang], -s) for lang, x in out.items() for i, (s, a, t, l, r) in enumerate(sorted(x)[: p.top]))


def got(docs, p):
    ship(docs.sparkSession)
    return sorted(tuple(r) for r in co.collocations(docs, p).collect())


def chatter(seed, n):
    """Short random texts with many repeats, marks and odd blanks."""
    r = random.Random(seed)
    some = ["a", "B", "c", "dd", "É", "é", "x y", "zz", "\U0001f600", "w\x00v", "the", "The"]
    glue = [" ", " ", " ", "  ", "\t", " \t ", ".", ", ", "\n", "! ", "\r\n", ":", " ;"]
    return ["".join(r.choice(some) + r.choice(glue) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    rows = [(t, lang) for seed, lang in ((1, "en"), (2, "en"), (3, None), (4, "und"), (5, "de")) for t in chatter(seed, 60)]
    rows += [("one long line without a mark " * 40, "en")] * 35 + [("b c " * 300, "de"), (None, "en"), ("", None), (None, None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for p in (co.Params(least=5), co.Params(least=30, top=7), co.Params(least=2, longest=3, covered=50, trigger=2), co.Params(least=5, trigger=1000)):
        want = brute(rows, p)
        assert want and got(docs, p) == want
    # blocks, runs and filters of the smallest sizes change nothing
    monkeypatch.setattr(co, "BLOCK_BYTES", 300)
    p = co.Params(least=5, filter_bits=18)
    table = spark.createDataFrame(rows, "text string, lang string").toPandas()
    parts = [co.parse(langs, texts, p) for langs, texts in co.texts_blocks(iter([_batch(table)]))]
    assert len(parts) > 20
    whole = Counter()
    for part in parts:
        for lang, chunk, own, n in zip(*(part[c].to_pylist() for c in ("lang", "chunk", "own", "n"))):
            whole[lang] += own * n
    assert whole == {lang: sum(len(re.findall(r"[^\x20\x09-\x0D.,;:!?]+", t or "")) for t, m in rows if (m or "und") == lang) for lang in whole}


def _batch(table):
    import pyarrow as pa
    return pa.record_batch({"lang": pa.array([x or "und" for x in table["lang"]]), "text": pa.array(table["text"])})


def test_awkward_rows(spark):
    p = co.Params(least=2)
    rows = [(r[1], r[2]) for r in cases.rows()]
    assert got(cases.documents(spark), p) == brute(rows, p)
    assert got(cases.documents(spark, clash=True), p) == brute(rows, p)
    assert got(cases.nothing(spark), p) == []
    assert got(cases.documents(spark), co.Params(least=10_000)) == []


def test_texts_longer_than_a_block_are_cut_at_marks():
    text = ("some words here. " * 50 + "x" * 700 + " end") .encode()
    parts = list(co.cut(text, 100))
    assert b"".join(parts) == text and len(parts) > 5
    assert all(p[-1:] == b"." for p in parts[:-1])


def test_merged_runs_equal_a_counter(monkeypatch):
    monkeypatch.setattr(runs, "BLOCK", 7)
    r = np.random.default_rng(3)
    want, blocks = Counter(), []
    for _ in range(40):
        keys, counts = runs.summed(r.integers(0, 1 << 40, 50) % 997, r.integers(1, 1 << 30, 50))
        for k, c in zip(keys.tolist(), counts.tolist()):
            want[k] += c
        for i in range(0, len(keys), 7):
            k = runs.unpack(runs.pack_keys(keys[i : i + 7])).cumsum() + keys[i]
            assert (k == keys[i : i + 7]).all()
            blocks.append((int(keys[i]), k, runs.unpack(runs.pack(counts[i : i + 7]))))
    out = list(runs.merge(iter(sorted(blocks, key=lambda b: b[0])), held=60))
    assert len(out) > 3
    keys = np.concatenate([k for k, _ in out])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([c for _, c in out]).tolist())) == want


def test_many_runs_are_joined_first(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(runs, "FAN", 4)
    rows = [b for i in range(30) for b in runs.rows_of(np.arange(i, 500 + i, dtype=np.int64), np.ones(500, np.int64), lambda k: k >> 8).to_pylist()]
    frame = spark.createDataFrame([(r["bucket"], r["first"], r["n"], r["keys"], r["counts"]) for r in rows], runs.SCHEMA)

    def emit(parts):
        import pyarrow as pa
        for keys, counts in parts:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

    out = {r.key: r.n for r in runs.merged(frame, 3, emit, "key bigint, n bigint", lambda k: k >> 8).collect()}
    assert out == Counter(k for i in range(30) for k in range(i, 500 + i))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equals_sql(spark, sf):
    from strata.llm.queries import op12_collocations
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf{sf}/documents.parquet'")
    cur = con.execute(oracles.COLLOCATIONS)
    names = [c[0] for c in cur.description]
    rows = cur.fetchall()
    df = op12_collocations(spark, f"/root/testdata/sf{sf}")
    assert rows and rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, rows)
