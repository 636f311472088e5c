"""Plan shapes that matter at scale, checked with the planner's size-based broadcast off
(what a cluster sees when the dimensions are large)."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, joins, silver
from strata.plans.inspect import plan_text


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _exchanges(txt: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", txt, flags=re.M))


def test_merge_shuffles_only_the_source(medallion, no_auto_broadcast):
    medallion.incremental()
    target = medallion.silver_versions("orders").as_of_version(0)
    source = medallion.wh.table("silver", "orders_changes")
    for check in (False, True):
        txt = plan_text(silver.upsert(target, source, "order_id", "2002-01-01 00:00:00", check=check))
        assert "SortMergeJoin FullOuter" in txt
        assert "Bucketed: true" in txt          # the target is read by bucket
        assert _exchanges(txt) == 1             # only the incoming rows move (the guard's window reuses it)


def test_fact_build_reads_orders_by_bucket(medallion, no_auto_broadcast):
    s = medallion.silver_table
    txt = plan_text(gold.fact_sales(s("orders"), s("order_items")))
    assert "Bucketed: true" in txt and _exchanges(txt) == 1


def test_marts_aggregate_below_the_join(medallion, no_auto_broadcast):
    f = medallion.fact()
    for df in (gold.top_products(f, medallion.gold_table("dim_products")),
               gold.revenue_by_state(f, medallion.gold_table("dim_customers"))):
        txt = plan_text(df)
        tree = txt.split("\n\n")[0]
        join_at = tree.index("SortMergeJoin")
        # a HashAggregate sits below (after, in the printed tree) the join: the fact is reduced first
        assert "HashAggregate" in tree[join_at:]


def test_split_skew_broadcasts_only_the_heavy_side(medallion, no_auto_broadcast):
    f = medallion.fact()
    d = medallion.gold_table("dim_customers").select("customer_id", "customer_name", "state")
    hot = joins.hot_keys(f, "customer_id", 45)
    txt = plan_text(joins.split_skew_join(f, d, "customer_id", hot, 1_000_000, "sales_id"))
    assert "BroadcastHashJoin Inner" in txt        # heavy keys x their dimension rows
    assert "SortMergeJoin Inner" in txt            # light keys: the regular shuffle join
    assert "BroadcastHashJoin LeftAnti" in txt


def test_many_hot_keys_never_shuffle_the_fact_by_the_raw_key(medallion, no_auto_broadcast):
    """Most customers are over the threshold, and their dimension rows over the bound: the
    halves are still told apart by a broadcast and the hot half is salted."""
    f = medallion.fact()
    d = medallion.gold_table("dim_customers").select("customer_id", "customer_name", "state")
    hot = joins.hot_keys(f, "customer_id", 1)
    assert hot.count() > 50
    txt = plan_text(joins.split_skew_join(f, d, "customer_id", hot, 1, "sales_id"))
    assert "SortMergeJoin LeftSemi" not in txt and "SortMergeJoin LeftAnti" not in txt
    assert "BroadcastHashJoin LeftSemi" in txt and "BroadcastHashJoin LeftAnti" in txt


def test_hot_key_is_spread_by_salting(medallion, spark):
    """One customer holding a third of the rows: the salted join spreads it over tasks
    and every strategy still returns the plain join's rows."""
    f = medallion.fact()
    hot = f.select("customer_id").first()[0]
    skewed = f.withColumn("customer_id", F.when(F.pmod(F.xxhash64("sales_id"), F.lit(3)) == 0, F.lit(hot))
                          .otherwise(F.col("customer_id")))
    d = medallion.gold_table("dim_customers").select("customer_id", "customer_name", "state")
    n_hot = skewed.filter(F.col("customer_id") == hot).count()
    assert n_hot > skewed.count() / 4

    hot_set = joins.hot_keys(skewed, "customer_id", n_hot // 2)
    assert [r.customer_id for r in hot_set.collect()] == [hot]
    plain = skewed.join(d, "customer_id")
    salted = joins.salted_join(skewed, d, "customer_id", 8, "sales_id", hot=hot_set)
    split = joins.split_skew_join(skewed, d, "customer_id", hot_set, 1_000_000, "sales_id")
    for v in (salted, split):
        cols = sorted(plain.columns)
        assert v.select(cols).exceptAll(plain.select(cols)).count() == 0
        assert plain.select(cols).exceptAll(v.select(cols)).count() == 0

    # shuffle join, and no AQE merging of the (tiny) shuffle partitions, so the
    # partition id after the join is the task that joined the row
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = (salted.filter(F.col("customer_id") == hot)
                    .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < n_hot * 0.75
