"""Benchmark: the medallion run and the headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Medallion stages (they write tables) are timed once on
a warm JVM; read-only queries are forced with a ``noop`` write and reported
as the median of BENCH_RUNS warm runs. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.config import Config  # noqa: E402
from strata.operators import gold, joins, layout  # noqa: E402
from strata.plans.medallion import MedallionRun  # noqa: E402
from strata.session import local_session  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)), app="strata-bench")
    cfg = Config()

    # warm the JVM on the smallest data (not timed)
    warm = MedallionRun(spark, "/root/testdata/sf0.001", cfg)
    warm.gold()

    p = MedallionRun(spark, sf_dir, cfg)
    out: dict[str, float] = {}
    out["land_raw_extracts"] = timed(p.land)
    out["bronze_ingest"] = timed(p.bronze)
    out["silver_full_load"] = timed(p.silver)
    out["gold_build"] = timed(p.gold)
    out["silver_incremental_merge"] = timed(p.incremental)
    out["partitioned_write"] = timed(p.partitioned_fact)
    out["zorder_rewrite"] = timed(p.zordered_fact)
    out["snapshot_commits"] = timed(p.fact_snapshots)

    f = p.fact()
    dc = p.gold_table("dim_customers")
    dp = p.gold_table("dim_products")
    dcs = dc.select("customer_id", "customer_name", "city", "state", "signup_date")
    heavy = joins.heavy_keys(f, "customer_id", cfg.heavy_key_threshold)
    fp = p.partitioned_fact()
    snaps = p.fact_snapshots()
    # a hot key: one customer takes a third of the lines (deterministic rule on the line id)
    hot = dcs.agg(F.min("customer_id")).first()[0]
    skewed = f.withColumn("customer_id", F.when(F.pmod(F.xxhash64("sales_id"), F.lit(3)) == 0, F.lit(hot))
                          .otherwise(F.col("customer_id"))).checkpoint(eager=True)
    hot_keys = joins.hot_keys(f, "customer_id", cfg.heavy_key_threshold, cfg.most_hot_keys)
    skew_hot = joins.hot_keys(skewed, "customer_id", cfg.heavy_key_threshold, cfg.most_hot_keys)
    queries = {
        "gold_revenue_by_state": lambda: gold.revenue_by_state(f, dc),
        "gold_top_products": lambda: gold.top_products(f, dp),
        "gold_daily_sales": lambda: gold.daily_sales(f),
        "gold_monthly_sales": lambda: gold.monthly_sales(f),
        "gold_sales_enriched": lambda: gold.sales_enriched(f, dc, dp),
        "join_fact_customer_auto": lambda: joins.join_auto(f, dcs, "customer_id"),
        "join_fact_customer_broadcast": lambda: joins.join_broadcast(f, dcs, "customer_id", cfg.max_broadcast_bytes),
        "join_salted": lambda: joins.salted_join(f, dcs, "customer_id", cfg.salt_buckets, "sales_id"),
        "join_salted_heavy": lambda: joins.salted_join(f, dcs, "customer_id", cfg.salt_buckets, "sales_id", hot=hot_keys),
        "join_split_skew": lambda: joins.split_skew_join(f, dcs, "customer_id", hot_keys, cfg.max_broadcast_bytes, "sales_id",
                                                         cfg.salt_buckets),
        "skew_top_keys": lambda: joins.top_keys(f, "customer_id", 20, "order_count"),
        "skew_heavy_keys": lambda: heavy,
        "product_sales_count": lambda: layout.count_by(fp, "product_id"),
        "partition_pruned_count": lambda: layout.count_by(
            fp.filter(layout.date_partition_filter("sales_date", "=", "2000-12-31")), "product_id"),
        "unpruned_date_count": lambda: layout.count_by(fp.filter(fp.sales_date == "2000-12-31"), "product_id"),
        "skewed_join_auto": lambda: joins.join_auto(skewed, dcs, "customer_id"),
        "skewed_join_salted_heavy": lambda: joins.salted_join(skewed, dcs, "customer_id", cfg.salt_buckets,
                                                              "sales_id", hot=skew_hot),
        "skewed_join_split": lambda: joins.split_skew_join(skewed, dcs, "customer_id", skew_hot,
                                                           cfg.max_broadcast_bytes, "sales_id", cfg.salt_buckets),
        "skewed_revenue_by_state": lambda: gold.revenue_by_state(skewed, dc),
        "snapshot_as_of_version": lambda: snaps.as_of_version(1),
        "snapshot_as_of_timestamp": lambda: snaps.as_of_timestamp("2024-01-01"),
    }
    for name, build in queries.items():
        samples = [timed(lambda: force(build())) for _ in range(runs)]
        out[name] = statistics.median(samples)

    # then with a real persist (first = fill, then served from the cache)
    star = gold.sales_enriched(f, dc, dp)
    out["star_join_count_first"] = timed(star.count)
    out["star_join_count_second"] = timed(star.count)
    cached = star.persist(StorageLevel.MEMORY_AND_DISK)
    out["star_join_count_first_with_cache"] = timed(cached.count)
    out["star_join_count_from_cache"] = statistics.median([timed(cached.count) for _ in range(runs)])
    speedup = out["star_join_count_first_with_cache"] / max(out["star_join_count_from_cache"], 1e-9)
    cached.unpersist()

    out = {k: round(v, 3) for k, v in out.items()}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "medallion_stage_seconds_plus_query_medians", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cache_speedup": round(speedup, 2)}))
    spark.stop()


if __name__ == "__main__":
    main()
