from strata.operators import joins
from strata.plans.inspect import plan_text


def _inputs(medallion):
    f = medallion.fact()
    d = medallion.gold_table("dim_customers").select("customer_id", "customer_name", "state")
    return f, d


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_all_strategies_equal_plain_join(medallion):
    f, d = _inputs(medallion)
    plain = f.join(d, "customer_id")
    hot = joins.hot_keys(f, "customer_id", 5)
    assert hot.count() > 0
    for variant in (
        joins.join_auto(f, d, "customer_id"),
        joins.join_broadcast(f, d, "customer_id", 1_000_000),
        joins.join_broadcast(f, d, "customer_id", 3),            # over the bound: shuffle join
        joins.salted_join(f, d, "customer_id", 7, "sales_id"),
        joins.salted_join(f, d, "customer_id", 7, "sales_id", hot=hot),
        joins.split_skew_join(f, d, "customer_id", hot, 1_000_000, "sales_id"),
        joins.split_skew_join(f, d, "customer_id", hot, 1, "sales_id", buckets=5),  # dimension over the bound: salted
    ):
        assert _same(variant, plain)


def test_broadcast_only_behind_the_bound(medallion):
    f, d = _inputs(medallion)
    assert "BroadcastHashJoin" in plan_text(joins.join_broadcast(f, d, "customer_id", 1_000_000))
    # over the bound no hint is placed; the planner's own size threshold decides
    big = joins.join_broadcast(f, d, "customer_id", 3)
    analyzed = plan_text(big, "extended").split("== Optimized Logical Plan ==")[0]
    assert "strategy=broadcast" not in analyzed
    hinted = plan_text(joins.join_broadcast(f, d, "customer_id", 1_000_000), "extended")
    assert "strategy=broadcast" in hinted.split("== Optimized Logical Plan ==")[0]


def test_salted_replicas_are_not_broadcast(spark, wh):
    """Whatever the planner takes the dimension's size for: its replicas go through a shuffle."""
    f = spark.createDataFrame([(i, None if i % 7 == 0 else i % 5) for i in range(60)], "sales_id bigint, customer_id bigint")
    d = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (3, None), (None, "n"), (9, "z")], "customer_id bigint, customer_name string")
    f, d = wh.save(f, "gold", "few_sales"), wh.save(d, "gold", "few_customers")   # files, so the planner knows their size
    salted = joins.salted_join(f, d, "customer_id", 4, "sales_id")
    assert "BroadcastHashJoin" in plan_text(f.join(d, "customer_id"))   # small enough to be broadcast once
    assert "Broadcast" not in plan_text(salted)
    assert _same(salted, f.join(d, "customer_id")) and salted.count() > 0
    rows = salted.select("sales_id", "customer_id", "customer_name")
    rows.collect()
    assert "Broadcast" not in plan_text(rows)    # nor when the shuffles' sizes are known


def test_byte_size_counts_text(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "a bigint, b string")
    assert joins.byte_size(df) == 1000 + 2 * 2 * 16
    assert joins.byte_size(df.limit(0)) == 0


def test_hot_keys_are_few_whatever_the_threshold(spark):
    df = spark.range(4000).selectExpr("id % 1000 AS k").unionByName(spark.range(2000).selectExpr("cast(7 AS bigint) AS k"))
    assert [r.k for r in joins.hot_keys(df, "k", 1, most=100).collect()] == [7]   # 4 rows are over 1, not over 1 %
    assert joins.hot_keys(df, "k", 1, most=10_000).count() == 1000
    assert joins.hot_keys(df.selectExpr("cast(NULL AS bigint) AS k"), "k", 1).count() == 0


def test_heavy_and_light_partition_the_fact(medallion):
    f, _ = _inputs(medallion)
    heavy = joins.heavy_keys(f, "customer_id", 5)
    hk = f.join(heavy.select("customer_id"), "customer_id", "left_semi")
    light = joins.light_rows(f, "customer_id", heavy, 1 << 20, "sales_id")
    assert hk.count() + light.count() == f.count()
    assert _same(light, joins.light_rows(f, "customer_id", heavy, 1, "sales_id", buckets=3))   # over the bound: salted


def test_top_keys_plan_and_order(medallion):
    f, _ = _inputs(medallion)
    top = joins.top_keys(f, "customer_id", 20, "order_count")
    assert "TakeOrderedAndProject" in plan_text(top)
    rows = top.collect()
    assert len(rows) == 20
    assert all((a.order_count, -a.customer_id) >= (b.order_count, -b.customer_id) for a, b in zip(rows, rows[1:]))
