"""A table asked for by name builds what it is made of, and no more."""

import __spark_entry__ as entry
import pytest

from strata.config import Config
from strata.operators import layout
from strata.plans import medallion
from strata.plans.medallion import GOLD_PARTS, MedallionRun, with_parts

SF_SMALL = "/root/testdata/sf0.001"


def tables(run):
    return {layer: {t.name for t in run.spark.catalog.listTables(run.wh.schema(layer))} if layer in built else set()
            for built in [{x for x in ("bronze", "silver", "gold") if run.spark.catalog.databaseExists(run.wh.schema(x))}] for layer in ("bronze", "silver", "gold")}


@pytest.mark.parametrize("query, raw", [
    ("bronze_orders", {"raw_orders"}),
    ("silver_products_load", {"raw_products"}),
    ("silver_customers_merge", {"raw_customers"}),
    ("silver_order_items_merge", {"raw_order_items"}),
    ("snapshot_changes", {"raw_orders"}),
    ("silver_reconcile_orders", {"raw_orders"}),
    ("silver_orders_two_history", {"raw_orders", "raw_customers"}),
    ("schema_checked_append", {"raw_products"}),
    ("snapshot_after_expiry_merged", {"raw_products"}),
    ("gold_revenue_by_state_incremental", {"raw_orders", "raw_order_items", "raw_customers"}),
    ("snapshot_history", {"raw_orders", "raw_order_items"}),
])
def test_a_query_loads_its_own_entities_only(spark, monkeypatch, query, raw):
    monkeypatch.setattr(medallion, "_CACHE", {})
    entry.queries()[query](spark, SF_SMALL).collect()
    run, = medallion._CACHE.values()
    assert tables(run)["bronze"] == raw


def test_the_fact_alone_builds_no_mart_and_no_joined_table(spark):
    run = MedallionRun(spark, SF_SMALL, Config())
    n = run.partitioned_fact().count()
    assert tables(run) == {"bronze": {"raw_orders", "raw_order_items"}, "silver": {"orders", "order_items"}, "gold": {"fact_sales", "fact_sales_partitioned"}}
    run.gold()
    assert tables(run)["gold"] == {*GOLD_PARTS, "fact_sales_partitioned"}
    assert run.fact().count() == n


def test_whole_stages_build_whole_layers(spark):
    run = MedallionRun(spark, SF_SMALL, Config())
    assert len(run.bronze()) == 4
    run.silver()
    assert tables(run)["silver"] == {"customers", "products", "orders", "order_items", "table_logger", "orders_with_customers", "orders_with_products"}


def test_entities_merged_one_after_another_share_the_control_table(spark):
    run, whole = (MedallionRun(spark, SF_SMALL, Config()) for _ in range(2))
    whole.incremental()
    for e in ("products", "orders", "customers", "order_items"):
        assert sorted(run.merged(e).collect(), key=str) == sorted(whole.merged(e).collect(), key=str)
        assert run.changes_of(e).count() == whole.changes_of(e).count()
    marks = [sorted(r.control().current().collect()) for r in (run, whole)]
    assert marks[0] == marks[1] and len(marks[0]) == 4


def test_parts_come_first():
    assert with_parts(("a",), {"a": ("b", "c"), "b": ("c",)}) == ["c", "b", "a"]


def test_extracts_are_landed_compressed_and_in_files_of_bounded_rows(spark, monkeypatch):
    from strata.sources import bronze

    monkeypatch.setattr(bronze, "FILE_ROWS", 100)
    run = MedallionRun(spark, SF_SMALL, Config())
    assert run.raw("customers").count() == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    files = bronze.read_raw_csv(spark, f"{run.wh.root}/raw_data/customers.csv").inputFiles()
    assert len(files) > 1 and all(f.endswith(".csv.gz") for f in files)


def test_sorted_files_grow_in_number_and_not_in_size(spark):
    """A file is sorted by one task: its rows, and the task's memory, follow the target and not the table."""
    target = 320_000
    run = MedallionRun(spark, "/root/testdata/sf0.01", Config(target_file_bytes=target))
    asked = layout.tasks_for(run.fact(), target // 8)
    assert asked > 8
    zordered = len(run.zordered_fact().inputFiles())
    assert asked // 2 < zordered <= asked
    table = run.clustered_sales()
    first = table._files([0])
    assert first.count() > asked // 2
    assert first.agg({"num_rows": "max"}).first()[0] < 2 * run.fact().count() / asked
