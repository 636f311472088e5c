import hashlib

import cases
import numpy as np
import pytest

from strata.llm import warc
from strata.llm.common import scratch

INNER = "before WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + "WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 100000\r\n\r\nnever\r\n\r\nafter"


def pages():
    big = cases.prose(1, 60)
    out = [(1, "http://a.example/1", big), (2, "http://a.example/2", big), (3, None, None), (4, "http://a.example/\r\nX: y", ""), (5, "u", "short"), (6, "u", "short")]
    out += [(7, "u", INNER), (8, "u", INNER * 3), (9, "u", INNER), (-4, "u", big), (10, "u", "WARC/1.0\r\n"), (11, "u", "\r\n\r\nWARC/1.0\r\n\r\n\r\n"), (12, "u", "ü" * 3000)]
    out += [(100 + i, f"http://b.example/{i}", cases.prose(i, 30 + i) + (INNER if i % 7 == 0 else "")) for i in range(60)]
    return out


def want(rows):
    first, out = {}, []
    for key, _, html in sorted(rows, key=lambda r: r[0]):
        b = (html or "").encode()
        digest = hashlib.sha256(b).hexdigest()
        if len(b) >= 100 and digest in first:
            out.append((key, len(b), digest, "revisit", first[digest]))
        else:
            first.setdefault(digest, key)
            out.append((key, len(b), digest, "response", None))
    return out


def got(df):
    return sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


@pytest.mark.parametrize("split", [None, "700"])
def test_round_trip_with_magic_in_payloads_and_over_splits(spark, split):
    docs = spark.createDataFrame(pages(), "page_id bigint, url string, html string").repartition(2)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert got(warc.round_trip(docs)) == want(pages())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_payloads_come_back(spark):
    docs = spark.createDataFrame(pages(), "page_id bigint, url string, html string")
    path = scratch(spark, "warc-test")
    warc.write_archives(docs, path)
    rows = warc.read_archives(spark, path, with_payload=True).collect()
    have = {r["record_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    for key, _, _, kind, _ in want(pages()):
        if kind == "response":
            assert have[f"<urn:page:{key}>"] == (dict((k, h) for k, _, h in pages())[key] or "").encode()


def test_what_follows_a_broken_record_is_not_returned(spark):
    path = scratch(spark, "warc-broken")
    good = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: 3\r\n\r\nabc"
    bad = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 7\r\n\r\nabc"
    rows = [good.format(1), good.format(2), bad, good.format(3)]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert sorted(r["record_id"] for r in warc.read_archives(spark, path).collect()) == ["<urn:page:1>", "<urn:page:2>"]


def test_null_ids_repeats_and_clashing_columns(spark):
    big = cases.prose(3, 60)
    rows = [(None, "u", big, "f"), (None, "u", big, "f"), (1, "u", big, "f"), (1, "u", big, "f"), (2, "u", big, "f")]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").selectExpr("*", "1 AS id", "2 AS bytes", "3 AS refers", "4 AS payload")
    out = warc.round_trip(docs).collect()
    assert len(out) == 5
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in out if r["page_id"] == 2) == [(2, "revisit", 1)]
    assert all(r["record_type"] == "response" for r in out if r["page_id"] != 2)


def test_no_rows(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_pointer_jumping():
    start = np.array([0, 10, 20, 30, 40, 50])
    succ = np.array([10, 30, 25, 99, 50, 60])
    assert warc.chain_ends(start, succ, 60).tolist() == [99, 99, -1, 99, 60, 60]
