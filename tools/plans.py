"""Print the formatted physical plans of the main operators (for plan review).

Usage: python tools/plans.py [sf_dir] [--no-auto-broadcast]
With --no-auto-broadcast the planner cannot broadcast by size, which shows the
shuffle plans a large cluster would get for big dimensions.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.config import Config  # noqa: E402
from strata.operators import gold, joins, layout, silver  # noqa: E402
from strata.plans.inspect import plan_text  # noqa: E402
from strata.plans.medallion import MedallionRun  # noqa: E402
from strata.session import local_session  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(8)
    p = MedallionRun(spark, sf, Config())
    p.gold()
    p.incremental()
    p.partitioned_fact()
    if "--no-auto-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    f, dc, dp = p.fact(), p.gold_table("dim_customers"), p.gold_table("dim_products")
    s = p.silver_table
    hot = joins.hot_keys(f, "customer_id", 60)
    dcs = dc.select("customer_id", "customer_name", "city", "state", "signup_date")
    fp = p.partitioned_fact()
    plans = {
        "fact_sales": gold.fact_sales(s("orders"), s("order_items")),
        "revenue_by_state": gold.revenue_by_state(f, dc),
        "top_products": gold.top_products(f, dp),
        "merge_orders": silver.upsert(p.silver_versions("orders").as_of_version(0), p.wh.table("silver", "orders_changes"),
                                      "order_id", "2002-01-01 00:00:00"),
        "incremental_source": silver.incremental_source(p.raw("orders"), "orders", "1999-01-01 00:00:00"),
        "salted": joins.salted_join(f, dcs, "customer_id", 10, "sales_id"),
        "split_skew": joins.split_skew_join(f, dcs, "customer_id", hot, 64 << 20, "sales_id"),
        "pruned": layout.count_by(fp.filter(layout.date_partition_filter("sales_date", "=", "2000-12-31")),
                                  "product_id"),
        "snapshot_v1": p.fact_snapshots().as_of_version(1).select("sales_id"),
    }
    plans["revenue_by_state_skewed_hot_customer"] = gold.revenue_by_state(
        f.withColumn("customer_id", F.when(F.pmod(F.xxhash64("sales_id"), F.lit(3)) == 0, F.lit(1))
                     .otherwise(F.col("customer_id"))), dc)
    plans["salted_heavy_only"] = joins.salted_join(f, dcs, "customer_id", 10, "sales_id", hot=hot)
    plans["zorder"] = layout.zorder_cluster(f, ["customer_id", "product_id", "sales_date"], 16)
    only = [a[2:] for a in sys.argv[1:] if a.startswith("--") and a[2:] in plans]
    tree_only = "--tree" in sys.argv
    for name, df in plans.items():
        if only and name not in only:
            continue
        txt = plan_text(df)
        if tree_only:
            # operator tree + the scan details that show pruning / pushdown
            tree = txt.split("\n\n")[0]
            scans = [ln for ln in txt.splitlines()
                     if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "Bucketed", "SelectedBucketsCount"))]
            txt = tree + "\n" + "\n".join(scans)
        print(f"\n### {name}\n```\n{txt.strip()}\n```")


if __name__ == "__main__":
    main()
