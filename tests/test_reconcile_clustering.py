"""Reconciliation by hash trees, clustering by increments, version differences, samples, profiles."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import joins, reconcile, schema, silver
from strata.operators.clustering import ClusteredTable
from strata.operators.skipping import scanned_files
from strata.operators.snapshots import SnapshotTable
from strata.plans.inspect import plan_text


def _sides(spark, rows_a, rows_b):
    shape = "k bigint, v string, n int"
    return spark.createDataFrame(rows_a, shape), spark.createDataFrame(rows_b, shape)


def _brute(rows_a, rows_b):
    out = {}
    for key in {r[0] for r in rows_a} | {r[0] for r in rows_b}:
        a, b = (sorted(map(str, (r for r in rows if r[0] == key))) for rows in (rows_a, rows_b))
        if a != b:
            out[key] = "missing in source" if not a else "missing in target" if not b else "different"
    return out


def test_findings_equal_brute_force(wh, spark):
    r = random.Random(4)
    a = [(i * 3 - 500, f"v{i % 7}", i) for i in range(2000)]
    b = list(a)
    for i in r.sample(range(2000), 12):
        b[i] = (b[i][0], "changed", b[i][2])
    b[7] = (b[7][0], None, b[7][2])
    b[8] = (b[8][0], b[8][1], None)
    del b[100:103]
    b += [(10**12, "new", 1), (-10**12, "new", 2), (a[50][0], a[50][1], a[50][2]), (None, "x", 1), (None, "x", 1)]
    a += [(5, "twice", 1), (5, "twice", 1), (None, "x", 1), (10**6, "late", 9)]
    left, right = _sides(spark, a, b)
    got = {x.k: x.finding for x in reconcile.reconcile(wh, left, right, "k", ["k", "v", "n"], "t").collect()}
    assert got == _brute(a, b) and None in got and got[a[50][0]] == "different"
    same, other = _sides(spark, a, a[::-1])
    assert reconcile.reconcile(wh, same, other, "k", ["k", "v", "n"], "t2").collect() == []
    none, some = _sides(spark, [], a[:3])
    assert {x.finding for x in reconcile.reconcile(wh, none, some, "k", ["k", "v", "n"], "t3").collect()} == {"missing in source"}


def test_late_rows_that_the_mark_misses_are_found_and_little_else_is_compared(wh, spark):
    rows = [(i, f"v{i}", i % 9) for i in range(20_000)]
    late = {777, 15_001}
    left, right = _sides(spark, [(k, "late" if k in late else v, n) for k, v, n in rows], rows)
    source = wh.save(left.repartitionByRange(16, "k"), "silver", "src")
    target = wh.save(right.repartitionByRange(16, "k"), "silver", "tgt")
    got = reconcile.reconcile(wh, source, target, "k", ["k", "v", "n"], "late", levels=2, leaf_bits=5)
    assert {x.k: x.finding for x in got.collect()} == dict.fromkeys(late, "different")
    leaves = wh.table("silver", "late_leaves")
    assert {x.node for x in leaves.collect()} == {k >> 5 for k in late}  # 64 of 20,000 rows are compared
    assert "LeftSemi" in plan_text(got) and "PushedFilters" in plan_text(got)
    tree = wh.table("silver", "late_source_tree")
    assert [x["count"] for x in tree.groupBy("level").count().orderBy("level").collect()] == [625, 40, 3]


def test_small_appends_rewrite_a_bounded_share(wh, spark):
    r = random.Random(2)
    table = ClusteredTable(wh, "gold", "clus", "c", target_bytes=1 << 20, most_depth=3)
    table.drop()
    table.append(spark.range(40_000).select("id", (F.col("id") * 7919 % 10_007).alias("c")), 20)
    assert table.depth() <= 2 and table.recluster() == (0, 20)
    rewritten, want = [], 40_000
    for k in range(9):
        rows = [(100_000 + 1000 * k + i, r.randint(0, 10_006)) for i in range(400)]  # 1 % each
        table.append(spark.createDataFrame(rows, "id bigint, c bigint"))
        want += 400
        rewritten.append(table.recluster()[0])
        assert table.depth() <= 3
        assert table.rows().count() == want
    assert max(rewritten) <= 4 and sum(rewritten) <= 16  # of 20 files and 9 appended ones
    assert table.rows().select("id").distinct().count() == want
    value = table.rows().orderBy(F.desc("id")).first().c
    found = table.lookup(value)
    assert sorted(x.id for x in found.collect()) == sorted(x.id for x in table.rows().filter(F.col("c") == value).collect())
    assert scanned_files(found) <= 3
    # a writer that died after the new run was there: the old runs go once
    runs = table._runs()
    wh.set_property("gold", "clus", "strata.joined", f"{runs[-1]}:{runs[-1] + 50}")
    table.repair()
    assert table.rows().count() == want and wh.property_of("gold", "clus", "strata.joined") == ""


def test_hot_values_and_nulls_cluster(wh, spark):
    table = ClusteredTable(wh, "gold", "hot", "c", target_bytes=1 << 20, most_depth=2)
    table.drop()
    for k in range(4):
        table.append(spark.range(300).select((F.col("id") + 300 * k).alias("id"), F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).cast("bigint").alias("c")), 2)
        table.recluster()
    assert table.rows().count() == 1200 and table.lookup(5).count() == 400 + 4


def test_version_changes_without_a_shuffle(wh, spark):
    st = SnapshotTable(wh, "silver", "chg", bucket_by=(8, "k"))
    shape = "k bigint, a string, b int, created_at timestamp_ntz, updated_at timestamp_ntz"
    base = spark.createDataFrame([(1, "x", 1, None, None), (2, "y", None, None, None), (3, "z", 3, None, None)], shape)
    st.commit(silver.stamp_load(base, "2024-01-01 00:00:00"), "2024-01-01 00:00:00")
    silver.merge_into(st, spark.createDataFrame([(2, "Y", 5, None, None), (3, "z", 3, None, None), (9, "n", 0, None, None)], shape), "k", "2024-01-02 00:00:00")
    st.commit(silver.stamp_load(base.filter("k <> 1"), "2024-01-03 00:00:00"), "2024-01-03 00:00:00")
    assert sorted(map(tuple, st.changes(0, 1).collect())) == [(2, "updated", "a,b"), (9, "inserted", None)]
    assert sorted(map(tuple, st.changes(1, 2).collect())) == [(1, "deleted", None), (2, "updated", "a,b"), (9, "deleted", None)]
    assert st.changes(1, 1).collect() == []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        assert "Exchange" not in plan_text(st.changes(0, 2)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ValueError):
        SnapshotTable(wh, "silver", "nokey").changes(0, 1)


def test_a_merge_shuffles_its_source_only(medallion, spark):
    """The joins of ``merge_into`` itself, on a chain of three merges."""
    st = medallion.state_revenue() and medallion.silver_versions("orders", "_mart")
    source = st.current().limit(5).select(*[c for c in st.current().columns if not c.startswith("record_")])
    source = medallion.wh.save(source, "silver", "few_orders")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = source.select("order_id").distinct()
        tree = plan_text(silver.upsert(st.current_of_keys(keys), source, "order_id", "2003-01-01 00:00:00")).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = tree.splitlines()
    for i, line in enumerate(lines):
        if "Exchange" in line and "Reused" not in line:
            below = "\n".join(lines[i : i + 8])
            assert "few_orders" in below  # no exchange stands above the versions


def test_samples_are_stable_and_whole(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 100 == 2, None).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"))
    one = sorted(map(str, joins.sample_by_group(df, "g", "id", 4).collect()))
    assert one == sorted(map(str, joins.sample_by_group(df.repartition(13), "g", "id", 4, parts=3).collect()))
    sizes = {r.g: r["count"] for r in joins.sample_by_group(df, "g", "id", 4).groupBy("g").count().collect()}
    want = {r.g: min(4, r["count"]) for r in df.groupBy("g").count().collect()}
    assert sizes == want and None in sizes
    # samples of parts merge into the sample of the whole
    parts = joins.sample_by_group(df.filter("id < 2000"), "g", "id", 4).unionByName(joins.sample_by_group(df.filter("id >= 2000"), "g", "id", 4))
    assert sorted(map(str, joins.sample_by_group(parts, "g", "id", 4).collect())) == one


def test_profile_of_columns(spark):
    df = spark.createDataFrame([(1, "b", None), (None, "a", None), (3, None, None)], "x int, y string, z date")
    rows = [tuple(r) for r in schema.profile(df, "t").orderBy("position").collect()]
    assert rows == [("t", 0, "x", "int", 3, 1, "1", "3"), ("t", 1, "y", "string", 3, 1, "a", "b"), ("t", 2, "z", "date", 3, 3, None, None)]
    assert [r.num_rows for r in schema.profile(df.limit(0), "t").collect()] == [0, 0, 0]
