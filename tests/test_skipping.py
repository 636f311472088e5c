import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import layout, silver
from strata.operators.skipping import FileIndex, only_files, scanned_files
from strata.operators.snapshots import SnapshotTable


def _rows(spark, ids, value):
    return spark.createDataFrame([(i,) for i in ids], "id bigint").select(
        "id", F.lit(value).alias("v"), F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))


@pytest.fixture()
def indexed(wh, spark):
    st = SnapshotTable(wh, "silver", "idx", bucket_by=(16, "id"), index=["id"])
    st.commit(silver.stamp_load(_rows(spark, range(0, 20_000, 2), "old"), "2024-01-01 00:00:00"), "2024-01-01 00:00:00")
    return st


def test_a_merge_reads_only_files_that_can_match(indexed, spark):
    """0.1 % of the keys: 10 of 10,000 in 16 buckets, and as many new ones."""
    st, n = indexed, 5
    source = _rows(spark, [*range(100, 100 + 400 * n, 400), *range(101, 101 + 400 * n, 400)], "new")
    keys = source.select("id")
    files = st.index.files_of_keys(keys, "id", 16, (0, 0))
    assert 1 <= len(files) <= 6 < st.index.count() == 16  # 5 keys that are there; odd ones are not
    read = st.current_of_keys(keys)
    assert sorted(r.id for r in read.collect()) == list(range(100, 100 + 400 * n, 400))
    assert scanned_files(read) == len(files)
    assert silver.merge_into(st, source, "id", "2024-01-05 00:00:00") == 1
    now = {r.id: (r.v, r.record_updated_at) for r in st.current().collect()}
    assert len(now) == 10_000 + n and sum(v == "new" for v, _ in now.values()) == 2 * n
    assert now[100] == ("new", dt.datetime(2024, 1, 5)) and now[101] == ("new", None) and now[102][0] == "old"


def test_a_chain_is_read_through_its_index(indexed, spark):
    st = indexed
    silver.merge_into(st, _rows(spark, [2, 4, 7], "b"), "id", "2024-01-05 00:00:00")
    silver.merge_into(st, _rows(spark, [4, 9], "c"), "id", "2024-01-06 00:00:00")
    assert SnapshotTable(st.wh, "silver", "idx").index.columns == ["id"]
    assert st.index.count() == st.index.count((0, 2)) > 16
    assert {r.id: r.v for r in st.current_of_keys(_rows(spark, [0, 2, 4, 7, 9, 11], "")).collect()} == {0: "old", 2: "b", 4: "c", 7: "b", 9: "c"}
    assert {r.id: r.v for r in st.current_of_keys(_rows(spark, [4], ""), version=1).collect()} == {4: "b"}
    assert st.current_of_keys(_rows(spark, [], "")).count() == 0
    st.compact("2024-01-07 00:00:00")
    assert st.vacuum(1, "2024-02-01") == [0, 1, 2]
    assert st.index.count((0, 2)) == 0 and st.index.count() == 16
    assert {r.id: r.v for r in st.current_of_keys(_rows(spark, [4, 5], "")).collect()} == {4: "c"}


def test_null_and_text_keys(wh, spark):
    st = SnapshotTable(wh, "silver", "txt", bucket_by=(4, "k"), index=["k"])
    df = spark.createDataFrame([("a", 1), ("ß", 2), (None, 3), ("", 4), ("z" * 300, 5)], "k string, n int")
    st.commit(df, "2024-01-01 00:00:00")
    keys = spark.createDataFrame([("ß",), ("",), (None,), ("nope",), ("z" * 300,)], "k string")
    assert sorted(r.n for r in st.current_of_keys(keys).collect()) == [2, 4, 5]


def test_point_lookups_in_a_zordered_table(medallion, wh, spark):
    fact = medallion.fact().select("sales_id", "customer_id", "product_id", "sales_date")
    wh.save(layout.zorder_cluster(fact, ["customer_id", "product_id", "sales_date"], 24), "gold", "z")
    index = FileIndex(wh, "gold", "z", ["customer_id", "product_id"])
    index.add()
    total = index.count()
    some = fact.groupBy("customer_id", "product_id").count().orderBy("customer_id", "product_id").first()
    for values in ({"customer_id": some.customer_id}, {"customer_id": some.customer_id, "product_id": some.product_id}):
        files = index.files_with(values)
        found = only_files(wh.table("gold", "z"), files)
        for c, v in values.items():
            found = found.filter(F.col(c) == v)
        want = fact
        for c, v in values.items():
            want = want.filter(F.col(c) == v)
        assert sorted(found.collect()) == sorted(want.collect())
        assert scanned_files(found) == len(files) < total
    assert len(files) <= total / 3  # two columns at once, of three in the z-order
    assert index.files_with({"customer_id": -1}) == [] and only_files(wh.table("gold", "z"), []).count() == 0
    low, high = fact.agg(F.min("customer_id"), F.max("customer_id")).first()
    assert len(index.files_with({}, {"customer_id": (low, high)})) == total
    assert len(index.files_with({}, {"customer_id": (low, low)})) < total


def test_filters_never_lose_a_value(wh, spark):
    wh.save(spark.range(0, 50_000, 1, 4).withColumn("k", F.col("id") * 7919), "gold", "b")
    index = FileIndex(wh, "gold", "b", ["k"])
    index.add()
    assert wh.table("gold", "b_files").agg(F.max("parts")).first()[0] > 1
    for v in (0, 7919, 7919 * 12_345, 7919 * 49_999):
        assert len(index.files_with({"k": v})) >= 1
    absent = [len(index.files_with({"k": 7919 * i + 1})) for i in (5, 17_000, 33_333)]
    assert sum(absent) <= 1  # ranges hold them, the filters do not
