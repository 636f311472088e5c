"""Runs that go on from earlier ones, and retention that tells the truth."""

import datetime as dt

import pytest

from strata.config import Config
from strata.operators.snapshots import SnapshotTable, VersionNotFound
from strata.plans.medallion import MedallionRun
from strata.sources import bronze
from strata.sources.tables import Warehouse

SF_SMALL = "/root/testdata/sf0.001"


def test_second_increment_goes_on_from_the_first(spark):
    wh = Warehouse(spark, Config())
    first = MedallionRun(spark, SF_SMALL, Config(incremental_ts="2001-06-01 00:00:00"), wh)
    first.incremental()
    again = MedallionRun(spark, SF_SMALL, Config(incremental_ts="2002-01-01 00:00:00"), wh)
    again.incremental()
    history = again.silver_versions("orders").history().collect()[::-1]
    assert [r["operation"] for r in history] == ["WRITE", "MERGE", "MERGE"]
    stamps = [r["timestamp"] for r in history]
    assert stamps == sorted(stamps) and len(set(stamps)) == 3
    marks = {r["table_name"]: r["last_run_time"] for r in again.control().current().collect()}
    assert set(marks.values()) == {dt.datetime(2002, 1, 1)} and len(marks) == 4


def test_rerun_writes_its_tables_again(spark):
    wh = Warehouse(spark, Config())
    run = MedallionRun(spark, SF_SMALL, Config(), wh)
    n = run.partitioned_fact().count()
    run.fact_snapshots()
    for name in ("fact_sales_partitioned",):
        spark.sql(f"TRUNCATE TABLE {wh.name('gold', name)}")
    again = MedallionRun(spark, SF_SMALL, Config(), wh)
    assert again.partitioned_fact().count() == n
    assert again.zordered_fact().count() == n
    assert again.fact_snapshots().versions().count() == 3
    assert again.products_with_append().count() >= again.gold_table("dim_products").count()


def test_schema_elsewhere_is_an_error(spark):
    wh = Warehouse(spark, Config())
    wh.ensure_layers()
    other = Warehouse(spark, Config(), prefix=wh.prefix)
    with pytest.raises(ValueError, match="not below"):
        other.ensure_schema("gold")


def test_unknown_expired_and_orphan_versions(spark, wh):
    st = SnapshotTable(wh, "gold", "numbers")
    for i, day in enumerate(("2024-01-01", "2024-01-10", "2024-01-20")):
        st.commit(spark.range(i + 1), f"{day} 00:00:00")
    with pytest.raises(VersionNotFound):
        st.as_of_version(99)
    due = st.expired(24, "2024-02-01 00:00:00").collect()
    assert [(r["version"], r["num_rows"]) for r in due] == [(0, 1), (1, 2)]
    # a commit that died before its history row
    spark.range(5).selectExpr("id", "cast(7 AS bigint) AS _version").write.mode("append").partitionBy("_version").saveAsTable(st.data)
    with pytest.raises(VersionNotFound):
        st.as_of_version(7)
    assert st.vacuum(24, "2024-02-01 00:00:00") == [0, 1]
    assert st._partition_versions() == {2}
    with pytest.raises(VersionNotFound):
        st.as_of_version(0)
    with pytest.raises(VersionNotFound):
        st.as_of_timestamp("2024-01-05 00:00:00")
    assert st.as_of_timestamp("2024-01-25 00:00:00").count() == 3
    assert st.expired(24, "2024-02-01 00:00:00").count() == 0 and st.vacuum(24, "2024-02-01 00:00:00") == []


def test_bucket_count_is_read_back(spark, wh):
    SnapshotTable(wh, "silver", "kept", (3, "id")).commit(spark.range(10), "2024-01-01 00:00:00")
    later = SnapshotTable(wh, "silver", "kept", (5, "id"))
    assert later.bucket_by == (3, "id")
    later.commit(spark.range(4), "2024-01-02 00:00:00")
    assert later.current().count() == 4


def test_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from strata import session

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_lookup_of_negative_and_padded_numbers(spark):
    df = spark.createDataFrame([("-5",), ("-05",), ("+5",), (" 5 ",), ("5",), ("15",), ("x5",), (None,)], "id string")
    assert sorted(r["id"] for r in bronze.lookup(df, "id", -5).collect()) == ["-05", "-5"]
    assert sorted(r["id"] for r in bronze.lookup(df, "id", 5).collect()) == [" 5 ", "+5", "5"]


def test_ingest_of_a_users_config(spark, tmp_path):
    spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string").write.option("header", True).csv(str(tmp_path / "own.csv"))
    config = bronze.write_config(spark, str(tmp_path / "config.json"), [(str(tmp_path / "own.csv"), "raw_own")])
    run = MedallionRun(spark, SF_SMALL, Config(), config_file=config)
    assert list(run.bronze()) == ["raw_own"]
    assert run.raw("own").count() == 2


def test_a_merge_writes_what_changes(spark, wh):
    """Bytes of a merge follow the increment; reads see whole tables; a full version lets old ones expire."""
    from strata.operators import silver

    shape = "id bigint, v string, record_created_at timestamp_ntz, record_updated_at timestamp_ntz"
    rows = spark.range(20_000).selectExpr("id", "concat('value ', id) AS v", "timestamp_ntz'2024-01-01' AS record_created_at", "cast(NULL AS timestamp_ntz) AS record_updated_at")
    st = SnapshotTable(wh, "silver", "slim", (3, "id"), key="id")
    st.commit(rows.unionByName(spark.createDataFrame([(None, "no key", None, None), (5, "again", None, None)], shape)), "2024-01-01 00:00:00")
    change = spark.range(100, 300).selectExpr("id", "'new' AS v").unionByName(spark.createDataFrame([(90_000, "in"), (90_000, "twice"), (None, "no key")], "id bigint, v string"))
    silver.merge_into(st, change, "id", "2024-01-02 00:00:00")
    silver.merge_into(st, spark.createDataFrame([(5, "both"), (150, "newer")], "id bigint, v string"), "id", "2024-01-03 00:00:00")
    folder = f"{wh.root}/silver/slim"
    size = {v: spark.read.format("binaryFile").load(f"{folder}/_version={v}").selectExpr("sum(length) AS n").first()["n"] for v in (0, 1)}
    assert size[1] < size[0] / 10
    now = st.current()
    assert now.count() == 20_002 + 3 == st.history(1).first()["num_rows"]
    got = {(r["id"], r["v"]) for r in now.where("id IN (5, 7, 150, 151, 90000) OR id IS NULL").collect()}
    assert got == {(5, "both"), (7, "value 7"), (150, "newer"), (151, "new"), (90_000, "in"), (90_000, "twice"), (None, "no key")}
    assert now.where("id IS NULL").count() == 2 and now.where("id = 5").count() == 2
    assert st.as_of_version(1).where("id = 150").first()["v"] == "new"
    assert st.vacuum(0, "2025-01-01 00:00:00") == []          # the latest version builds on all of them
    st.compact("2024-01-04 00:00:00")
    assert st.vacuum(0, "2025-01-01 00:00:00") == [0, 1, 2] and st.current().count() == 20_005
