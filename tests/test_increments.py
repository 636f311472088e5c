"""Marts by signed deltas, mergeable distinct counts, frequent keys, pruning through a join."""

import datetime as dt
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.operators import gold, increments, joins, layout, silver
from strata.operators.increments import StateRevenue
from strata.operators.skipping import scanned_files
from strata.operators.snapshots import SnapshotTable
from strata.plans.inspect import plan_text

STAMPS = ", created_at timestamp_ntz, updated_at timestamp_ntz"
T0 = dt.datetime(2000, 1, 1)


def frames(spark, orders, items, customers):
    o = spark.createDataFrame([(*r, T0, None) for r in orders], "order_id bigint, customer_id bigint" + STAMPS)
    i = spark.createDataFrame([(*r, T0, None) for r in items], "order_item_id bigint, order_id bigint, product_id bigint, quantity int, price int" + STAMPS)
    c = spark.createDataFrame([(*r, T0, None) for r in customers], "customer_id bigint, state string" + STAMPS)
    return o, i.withColumn("price", F.col("price").cast("decimal(12,2)")), c


def rebuilt(orders, items, customers):
    """The mart as the gold layer builds it from whole tables."""
    fact = orders.select("order_id", "customer_id").join(items, "order_id").select(
        "order_id", "customer_id", F.lit(dt.date(2000, 1, 1)).alias("sales_date"), (F.col("quantity") * F.col("price")).alias("line_total"), "quantity")
    return sorted(map(str, gold.state_revenue(gold.order_totals(fact), customers).collect()))


def test_deltas_equal_a_rebuild_with_retractions(wh, spark):
    names = ("orders", "order_items", "customers")
    keys = dict(zip(names, ("order_id", "order_item_id", "customer_id")))
    tables = {n: SnapshotTable(wh, "silver", f"{n}_inc", bucket_by=(4, keys[n]), index=[keys[n]]) for n in names}
    r = random.Random(5)
    orders = [(i, r.randint(1, 30) if i % 17 else None) for i in range(200)]
    items = [(k * 100 + j, k, r.randint(1, 9), r.randint(1, 5), r.randint(1, 90)) for k in range(190) for j in range(r.randint(1, 4))]
    customers = [(c, f"S{c % 5}") for c in range(1, 25)]  # orders of 25 to 30 join nothing
    for n, df in zip(names, frames(spark, orders, items, customers)):
        tables[n].commit(silver.stamp_load(df, "2001-01-01 00:00:00"), "2001-01-01 00:00:00")
    mart = StateRevenue(wh, "inc", 4)
    mart.build(*(t.current() for t in tables.values()), "2001-01-01 00:00:00")

    def current():
        return [tables[n].current() for n in names]

    assert sorted(map(str, mart.mart().collect())) == rebuilt(*current())
    steps = [
        # customer 3's orders all go to 4; a line moves from one order to another; one customer moves
        ([(i, 4) for i, c in orders if c == 3], [(500, 6, 1, 2, 10)], [(7, "S0")]),
        # an order that had no line gets some, one is new; a new state; a customer that was unknown
        ([(400, 5)], [(19500, 195, 1, 3, 7), (40000, 400, 2, 1, 50)], [(9, "new"), (26, "S1")]),
        ([], [], [(c, "one") for c in range(1, 25)]),
        ([(i, 2) for i in range(0, 200, 3)], [], []),
    ]
    for k, (o, i, c) in enumerate(steps):
        ts = f"2001-02-{k + 1:02d} 00:00:00"
        changes = frames(spark, o, i, c)
        for n, df in zip(names, changes):
            silver.merge_into(tables[n], df, keys[n], ts)
        mart.refresh(*tables.values(), *changes, ts)
        assert sorted(map(str, mart.mart().collect())) == rebuilt(*current()), k
    states = {x.state: x.unique_customers for x in mart.mart().collect()}
    assert states.keys() >= {"one"} and mart.totals.history().count() == 5
    assert {x.operation for x in mart.customers.history().collect()} == {"WRITE", "MERGE"}


def test_a_refresh_reads_changed_orders_only(medallion, spark):
    """Rows of one changed order, before and after, out of the run's tables."""
    medallion.state_revenue()
    orders = medallion.silver_versions("orders", "_mart")
    some = orders.current().select("order_id").orderBy("order_id").limit(1)
    ids = spark.createDataFrame(some.collect(), "order_id bigint")
    read = orders.current_of_keys(ids)
    assert read.count() == 1
    text = plan_text(read)
    assert "LeftSemi" in text and "Bucketed: true" in text
    items = medallion.silver_versions("order_items", "_mart")
    with_order = items.current_with(ids, "order_id")
    assert {r.order_id for r in with_order.select("order_id").collect()} == {ids.first().order_id}
    want = items.current().filter(F.col("order_id") == ids.first().order_id)
    assert sorted(map(str, with_order.collect())) == sorted(map(str, want.collect()))


def test_two_versions_are_read_at_once(wh, spark):
    """Lines that stay, change, are new, repeat or have no key; on one chain, across two and with full versions only."""
    def rows(*r):
        return spark.createDataFrame(r, "order_item_id bigint, v string")

    st = SnapshotTable(wh, "silver", "two_sides", bucket_by=(3, "order_item_id"))
    st.commit(rows((1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "n")), "2001-01-01 00:00:00")
    for k, changed in enumerate((rows((2, "B"), (4, "d"), (None, "m")), rows((1, "A"), (4, "D"), (5, "e"), (5, "e"), (None, "n")))):
        st.commit_changes(changed, f"2001-01-{k + 2:02d} 00:00:00", F.lit(True))
    st.compact("2001-01-09 00:00:00")
    plain = SnapshotTable(wh, "silver", "two_sides_plain")
    for k in range(2):
        plain.commit(rows((1, f"a{k}"), (2, "b")), f"2001-01-{k + 1:02d} 00:00:00")
    for table, old, new in ((st, 0, 1), (st, 1, 2), (st, 0, 2), (st, 2, 3), (st, 1, 1), (plain, 0, 1)):
        both = table.of_two_versions(old, new)
        for side, v in ((2, old), (1, new)):
            got = both.filter(F.col("_side") != side).drop("_side")
            assert sorted(map(str, got.collect())) == sorted(map(str, table.as_of_version(v).select(got.columns).collect())), (old, new)


def test_lines_of_both_versions_move_by_order_once(medallion, spark):
    """Not broadcast, the changed orders' lines are one shuffle for the contributions before and after."""
    st = medallion.state_revenue()
    orders, items = (medallion.silver_versions(e, "_mart") for e in ("orders", "order_items"))
    ids = medallion.wh.table("gold", "state_revenue_changed_orders")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = st.delta(ids, orders, items)
        text = plan_text(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scans = re.findall(r"^\(\d+\) Scan parquet \S*order_items_versions_mart", text, flags=re.M)
    assert len(scans) == 2  # the keyed lines, and those without a key
    moved = re.findall(r"^\(\d+\) Exchange.*\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(order_id", text, flags=re.M)
    assert len([x for x in moved if "price" in x]) == 2  # those of each scan, once
    assert not [x for x in moved if "sum" in x or "revenue" in x]  # and not again as sums
    after = increments.by_customer(increments.order_contributions(orders.current(), items.current())).agg(F.sum("orders")).first()[0]
    o, i = orders.log()[-2]["version"], items.log()[-2]["version"]
    before = increments.by_customer(increments.order_contributions(orders.as_of_version(o), items.as_of_version(i))).agg(F.sum("orders")).first()[0]
    assert df.agg(F.sum("orders")).first()[0] == after - before


def test_state_mart_after_two_increments_equals_a_rebuild(medallion):
    mart = medallion.state_revenue().mart()
    o, i, c = (medallion.silver_versions(e, "_mart").current() for e in ("orders", "order_items", "customers"))
    totals = gold.order_totals(gold.fact_sales(o, i))
    want = gold.state_revenue(totals, c)
    assert sorted(map(str, mart.collect())) == sorted(map(str, want.select(mart.columns).collect()))


def test_month_from_day_sets_without_expand(medallion):
    sums, sets = medallion.daily_sets()
    df = increments.monthly_from_daily(sums, sets)
    assert "Expand" not in plan_text(df)
    assert "Expand" in plan_text(gold.by_month(medallion.gold_table("order_totals")))
    want = gold.by_month(medallion.gold_table("order_totals"))
    assert sorted(map(str, df.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_day_sets_with_awkward_ids(spark):
    big = 1 << 40
    rows = [("2020-01-01", 1, 7), ("2020-01-02", 1, 7), ("2020-01-31", big, None), ("2020-02-01", None, -5), ("2020-02-02", None, -5), ("2020-01-31", 32768, 0), (None, 5, 6)]
    totals = spark.createDataFrame([(d, o, c, 10, 1, 2) for d, o, c in rows], "d string, order_id bigint, customer_id bigint, revenue int, lines bigint, quantity int")
    totals = totals.select(F.to_date("d").alias("sales_date"), "order_id", "customer_id", F.col("revenue").cast("decimal(12,2)").alias("revenue"), "lines", "quantity")
    got = increments.monthly_from_daily(increments.daily_sums(totals), increments.daily_bitmaps(totals))
    want = gold.by_month(totals)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_summaries_miss_no_frequent_key():
    r = random.Random(1)
    for size in (1, 3, 10):
        stream = [r.choice("aaaabbbccd") if r.random() < 0.6 else f"x{r.randint(0, 500)}" for _ in range(3000)]
        parts, counters = [stream[i : i + 700] for i in range(0, 3000, 700)], []
        for part in parts:
            own: dict = {}
            for i in range(0, len(part), 90):
                own = joins.summary(pa.array(part[i : i + 90] + [None]), own, size)
            assert len(own) <= size
            counters.append(own)
        merged = Counter()
        for own in counters:
            merged.update(own)
        for key, n in Counter(stream).items():
            assert merged[key] >= n - len(stream) / (size + 1) and merged[key] <= n


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_frequent_keys_are_exact_and_their_shuffle_is_bounded(spark, kind):
    rows = spark.range(0, 40_000, 1, 8).withColumn("k", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).when(F.col("id") % 50 == 4, None).otherwise(F.col("id") + 100).cast(kind))
    want = {r.k: r.row_count for r in joins.key_counts(rows.filter("k IS NOT NULL"), "k").collect()}
    total = sum(want.values())
    for most in (2, 5, 20):
        got = {r.k: r.row_count for r in joins.frequent_keys(rows, "k", most).collect()}
        assert got == {k: n for k, n in want.items() if n * most > total}
        assert joins.frequent_candidates(rows, "k", most).count() < 2 * most
    assert joins.frequent_keys(rows.limit(0), "k", 5).collect() == []
    # what the tasks send: at most their counters and one row count each
    exchange = rows.select("k").repartition(6)
    assert joins.frequent_candidates(exchange, "k", 4).count() < 8


def test_pruning_through_a_join(medallion):
    fact = medallion.partitioned_fact()
    months = layout.calendar(fact, "sales_date").filter((F.col("quarter") == 1) & ~F.col("year_end"))
    df = layout.join_months(fact, months)
    text = plan_text(df)
    assert "dynamicpruningexpression" in text
    want = fact.filter(F.month("sales_date") <= 3)
    assert df.count() == want.count() > 0
    rows = layout.join_months(fact, months).select("sales_id", "sales_date")
    assert {r.sales_date.month for r in rows.collect()} == {1, 2, 3}
    everything = fact.select("sales_id", "sales_date")
    everything.collect()
    assert scanned_files(rows) < scanned_files(everything) / 2 + len(months.collect())


def test_layouts_grow_with_the_data(spark):
    df = spark.range(1000).withColumn("customer_id", F.lit(1))
    for name, n in (("repartition_20", 50), ("coalesce_4_from_20", 50), ("coalesce_40_from_20", 50)):
        assert layout.layouts(df, "customer_id", tasks=50)[name].rdd.getNumPartitions() == n
    spread = layout.partition_profile(layout.layouts(df, "customer_id", tasks=50)["repartition_10_by_customer_id"], "x").first()
    assert spread.rows == 1000 and spread.partitions > 1  # one customer is not one task
