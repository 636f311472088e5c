import datetime as dt

import pytest

from strata.operators import schema
from strata.operators.snapshots import SnapshotTable, VersionNotFound


def test_versions_history_and_time_travel(wh, spark):
    st = SnapshotTable(wh, "gold", "t")
    base = spark.range(10).withColumnRenamed("id", "k")
    assert st.latest_version() is None
    st.commit(base.filter("k < 3"), "2024-01-01 00:00:00", "CREATE TABLE AS SELECT")
    st.commit(base.filter("k < 6"), "2024-01-10 00:00:00")
    st.commit(base, "2024-01-20 00:00:00")
    assert st.latest_version() == 2
    assert [r.version for r in st.history().collect()] == [2, 1, 0]
    assert [r.num_rows for r in st.history().collect()] == [10, 6, 3]
    assert st.current().count() == 10
    assert st.as_of_version(1).count() == 6
    assert st.as_of_timestamp("2024-01-15").count() == 6
    assert st.as_of_timestamp(dt.datetime(2024, 1, 1)).count() == 3
    with pytest.raises(VersionNotFound):
        st.as_of_timestamp("2023-12-31")


def test_retention_never_drops_latest(wh, spark):
    st = SnapshotTable(wh, "gold", "r")
    base = spark.range(5)
    st.commit(base, "2024-01-01 00:00:00")
    st.commit(base, "2024-01-02 00:00:00")
    # far in the future: everything superseded expires, the latest stays
    gone = st.vacuum(168, "2030-01-01 00:00:00")
    assert gone == [0]
    assert sorted(r.version for r in st.versions().collect()) == [1]
    assert st.current().count() == 5
    # dry run after the fact: nothing left to remove but version 0's history row
    assert st.expired(168, "2024-01-03 00:00:00").count() == 0


def test_schema_guard(wh, spark):
    wh.ensure_schema("gold")
    target = spark.createDataFrame(
        [(1, "a", "c", 1.5, None)], "product_id int, product_name string, category string, price double, created_at timestamp_ntz")
    wh.save(target, "gold", "p")
    name = wh.name("gold", "p")
    bad = spark.createDataFrame([(7, "lamp", "n/a")], "product_id int, product_name string, price string")
    with pytest.raises(schema.SchemaMismatch):
        schema.guarded_append(spark, name, bad)
    extra = spark.createDataFrame([(2, "x")], "product_id int, color string")
    with pytest.raises(schema.SchemaMismatch):
        schema.guarded_append(spark, name, extra)
    ok = spark.createDataFrame([(2, "b", "d", 2.5)], "product_id int, product_name string, category string, price double")
    out = schema.guarded_append(spark, name, ok)
    assert out.count() == 2
    assert out.filter("product_id = 2").first()["created_at"] is None


def test_schema_listing(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = schema.schema_listing(spark, df).collect()
    assert [(r.column_name, r.data_type) for r in rows] == [("a", "int"), ("b", "string")]


def test_merge_into_versioned_table(wh, spark):
    from strata.operators import silver
    st = SnapshotTable(wh, "silver", "m", bucket_by=(4, "id"))
    base = spark.createDataFrame(
        [(1, "a", dt.datetime(2000, 1, 1), None), (2, "b", dt.datetime(2000, 1, 1), None)],
        "id bigint, v string, created_at timestamp_ntz, updated_at timestamp_ntz")
    st.commit(silver.stamp_load(base, "2001-01-01 00:00:00"), "2001-01-01 00:00:00")
    src = spark.createDataFrame([(2, "B", dt.datetime(2000, 1, 1), dt.datetime(2001, 6, 1)),
                                 (3, "c", dt.datetime(2001, 7, 1), None)],
                                "id bigint, v string, created_at timestamp_ntz, updated_at timestamp_ntz")
    v = silver.merge_into(st, src, "id", "2002-01-01 00:00:00")
    assert v == 1
    assert [(r.version, r.operation) for r in st.history().collect()] == [(1, "MERGE"), (0, "WRITE")]
    cur = {r.id: r for r in st.current().collect()}
    assert cur[2].v == "B" and cur[2].record_updated_at == dt.datetime(2002, 1, 1)
    assert cur[3].record_created_at == dt.datetime(2002, 1, 1) and cur[1].v == "a"
    assert {r.id: r.v for r in st.as_of_version(0).collect()} == {1: "a", 2: "b"}   # time travel to pre-merge


def test_commit_after_orphan_data_skips_that_version(wh, spark):
    st = SnapshotTable(wh, "gold", "orph")
    st.commit(spark.range(3), "2024-01-01 00:00:00")
    # a run that died after writing version 1's data but before its history row
    from pyspark.sql import functions as F
    spark.range(7).withColumn("_version", F.lit(1).cast("long")).write.mode("append").format("parquet") \
        .partitionBy("_version").saveAsTable(st.data)
    assert st.latest_version() == 0 and st.current().count() == 3   # readers follow the history
    v = st.commit(spark.range(5), "2024-01-02 00:00:00")
    assert v == 2 and st.current().count() == 5
    assert sorted(r.version for r in st.versions().collect()) == [0, 2]


def _changes(spark, rows):
    return spark.createDataFrame([(k, v, dt.datetime(2000, 1, 1), None) for k, v in rows],
                                 "id bigint, v string, created_at timestamp_ntz, updated_at timestamp_ntz")


def test_retention_keeps_what_a_kept_version_builds_on(wh, spark):
    from strata.operators import silver
    st = SnapshotTable(wh, "silver", "chain", bucket_by=(4, "id"))
    st.commit(silver.stamp_load(_changes(spark, [(1, "a"), (2, "b")]), "2024-01-01 00:00:00"), "2024-01-01 00:00:00")
    silver.merge_into(st, _changes(spark, [(2, "B"), (3, "c")]), "id", "2024-01-05 00:00:00")
    silver.merge_into(st, _changes(spark, [(1, "A")]), "id", "2024-01-20 00:00:00")
    st.compact("2024-01-24 00:00:00")
    want = [{1: "a", 2: "b"}, {1: "a", 2: "B", 3: "c"}, {1: "A", 2: "B", 3: "c"}, {1: "A", 2: "B", 3: "c"}]

    def read(v):
        return {r.id: r.v for r in st.as_of_version(v).collect()}

    # version 2 was superseded on the 24th, so it, and all that it is read through, stay
    assert st.expired(168, "2024-01-25").collect() == [] and st.vacuum(168, "2024-01-25") == []
    assert [read(v) for v in range(4)] == want
    assert sorted(st.vacuum(168, "2024-02-05")) == [0, 1, 2]
    assert read(3) == want[3] and st.vacuum(168, "2024-02-05") == []
    for v in range(3):
        with pytest.raises(VersionNotFound):
            st.as_of_version(v)
    # a new object reads the same way: the key is the table's
    assert SnapshotTable(wh, "silver", "chain").key == "id"
    silver.merge_into(SnapshotTable(wh, "silver", "chain"), _changes(spark, [(9, "z")]), "id", "2024-02-06 00:00:00")
    assert {r.id for r in SnapshotTable(wh, "silver", "chain").current().collect()} == {1, 2, 3, 9}


def test_merge_without_a_key_writes_full_versions(wh, spark):
    from strata.operators import silver
    st = SnapshotTable(wh, "silver", "plain")
    st.commit(silver.stamp_load(_changes(spark, [(1, "a"), (2, "b")]), "2024-01-01 00:00:00"), "2024-01-01 00:00:00")
    silver.merge_into(st, _changes(spark, [(2, "B"), (3, "c")]), "id", "2024-01-05 00:00:00")
    silver.merge_into(st, _changes(spark, [(4, "d")]), "id", "2024-01-20 00:00:00")
    assert st.key is None and [(r.operation, r.num_rows) for r in st.history().collect()] == [("MERGE", 4), ("MERGE", 3), ("WRITE", 2)]
    assert {r.id: r.v for r in st.as_of_version(1).collect()} == {1: "a", 2: "B", 3: "c"}
    assert {r.id: r.v for r in st.current().collect()} == {1: "a", 2: "B", 3: "c", 4: "d"}
    assert st.vacuum(24, "2024-01-15") == [0]
