"""

``entry(spark)`` runs the flagship query (revenue by state) on sf0.001;
DataFrame callable; ``oracle_sql()`` gives the DuckDB text for the same key.

Outputs present money as double (exact decimal inside, one conversion at the
end) so both engines hash the same values.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_model as om  # noqa: E402
from strata.operators import gold, increments, joins, layout, schema, silver, skipping  # noqa: E402
from strata.plans.medallion import GONE, LATE, LOST, MIDDLE_TS, SNAPSHOT_NOW, run_for  # noqa: E402
from strata.sources import bronze, retail  # noqa: E402

try:  # the corpus operators are an optional part
    import strata.llm.queries as llm
except ModuleNotFoundError as e:
    if (e.name or "").split(".")[:2] not in (["strata", "llm"], ["corpus_pipeline"]):
        raise
    llm = None

SF_SMOKE = "/root/testdata/sf0.001"


def present(df: DataFrame) -> DataFrame:
    """Decimal columns as double for engine-neutral comparison."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _p(spark, sf_dir):
    return run_for(spark, sf_dir)


# -- bronze ------------------------------------------------------------------------

def q_bronze_ingest_counts(spark, sf_dir):
    p = _p(spark, sf_dir)
    return bronze.bronze_counts(p.wh, p.bronze())


def q_bronze_orders(spark, sf_dir):
    return _p(spark, sf_dir).raw("orders")


def q_bronze_product_lookup(spark, sf_dir):
    return bronze.lookup(_p(spark, sf_dir).raw("products"), "product_id", 150)


def q_bronze_quarantine(spark, sf_dir):
    """Rows loaded and lines set apart, by reason, of an extract with broken lines."""
    good, bad = _p(spark, sf_dir).guarded_orders()
    rows = good.select("source_file_name", F.lit("loaded").alias("reason")).unionByName(bad.select("source_file_name", "reason"))
    return rows.groupBy("source_file_name", "reason").agg(F.count(F.lit(1)).alias("row_count"))


# -- silver -------------------------------------------------------------------------

def _silver_load(entity):
    def q(spark, sf_dir):
        return present(_p(spark, sf_dir).silver_table(entity))
    return q


def q_silver_logger_init(spark, sf_dir):
    return _p(spark, sf_dir).silver_table("table_logger")


def q_silver_key_check(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return silver.key_check(li, ["l_orderkey", "l_linenumber"])


def q_silver_reject_report(spark, sf_dir):
    """Rejects of a damaged extract (the strict loads read the clean one)."""
    out = None
    for e in ("customers", "order_items", "orders", "products"):
        typed = retail.entity(spark, sf_dir, e).select([c for c, _ in silver.SPECS[e]])
        r = silver.reject_summary(retail.as_dirty_raw(typed, silver.KEYS[e]), e)
        out = r if out is None else out.unionByName(r)
    return out


def q_silver_incremental_orders(spark, sf_dir):
    return present(_p(spark, sf_dir).changes_of("orders"))


def _silver_merge(entity):
    def q(spark, sf_dir):
        return present(_p(spark, sf_dir).merged(entity))
    return q


def q_silver_orders_history(spark, sf_dir):
    p = _p(spark, sf_dir)
    p.merged("orders")
    return p.silver_versions("orders").history()


def q_silver_logger_update(spark, sf_dir):
    p = _p(spark, sf_dir)
    p.two_increments()
    return p.control("_two").current()


def q_silver_orders_two_increments(spark, sf_dir):
    p = _p(spark, sf_dir)
    p.two_increments()
    return present(p.silver_versions("orders", "_two").current())


def q_silver_orders_two_history(spark, sf_dir):
    p = _p(spark, sf_dir)
    p.two_increments()
    return p.silver_versions("orders", "_two").history()


def q_silver_orders_with_customers(spark, sf_dir):
    return present(_p(spark, sf_dir).silver_table("orders_with_customers"))


def q_silver_orders_with_products(spark, sf_dir):
    return present(_p(spark, sf_dir).silver_table("orders_with_products"))


# -- gold -----------------------------------------------------------------------------

def _gold_table(name):
    def q(spark, sf_dir):
        return present(_p(spark, sf_dir).gold_table(name))
    return q


def q_gold_revenue_by_state(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.ordered(gold.revenue_by_state(p.fact(), p.gold_table("dim_customers")), "agg_revenue_by_state")


def q_gold_top_products(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.ordered(gold.top_products(p.fact(), p.gold_table("dim_products")), "agg_top_products")


def q_gold_daily_sales(spark, sf_dir):
    return gold.ordered(gold.daily_sales(_p(spark, sf_dir).fact()), "agg_daily_sales")


def q_gold_monthly_sales(spark, sf_dir):
    return gold.ordered(gold.monthly_sales(_p(spark, sf_dir).fact()), "agg_monthly_sales")


def q_gold_revenue_by_state_incremental(spark, sf_dir):
    return _p(spark, sf_dir).state_revenue().mart()


def q_gold_monthly_from_daily_bitmaps(spark, sf_dir):
    return increments.monthly_from_daily(*_p(spark, sf_dir).daily_sets())


def _mart(name):
    def q(spark, sf_dir):
        return gold.ordered(_p(spark, sf_dir).gold_table(name), name)
    return q


def q_gold_sales_enriched(spark, sf_dir):
    p = _p(spark, sf_dir)
    return present(gold.sales_enriched(p.fact(), p.gold_table("dim_customers"), p.gold_table("dim_products")))


# -- joins and skew ------------------------------------------------------------------------

def _fact_and_customers(spark, sf_dir):
    p = _p(spark, sf_dir)
    dim = p.gold_table("dim_customers").select("customer_id", "customer_name", "city", "state", "signup_date")
    return p, p.fact(), dim


def q_join_fact_customer_auto(spark, sf_dir):
    _, f, d = _fact_and_customers(spark, sf_dir)
    return present(joins.join_auto(f, d, "customer_id"))


def q_join_fact_customer_broadcast(spark, sf_dir):
    p, f, d = _fact_and_customers(spark, sf_dir)
    return present(joins.join_broadcast(f, d, "customer_id", p.config.max_broadcast_bytes))


def q_join_salted(spark, sf_dir):
    p, f, d = _fact_and_customers(spark, sf_dir)
    return present(joins.salted_join(f, d, "customer_id", p.config.salt_buckets, "sales_id"))


def q_join_salted_heavy(spark, sf_dir):
    p, f, d = _fact_and_customers(spark, sf_dir)
    hot = joins.hot_keys(f, "customer_id", p.config.heavy_key_threshold, p.config.most_hot_keys)
    return present(joins.salted_join(f, d, "customer_id", p.config.salt_buckets, "sales_id", hot=hot))


def q_join_split_skew(spark, sf_dir):
    p, f, d = _fact_and_customers(spark, sf_dir)
    hot = joins.hot_keys(f, "customer_id", p.config.heavy_key_threshold, p.config.most_hot_keys)
    return present(joins.split_skew_join(f, d, "customer_id", hot, p.config.max_broadcast_bytes, "sales_id",
                                         p.config.salt_buckets))


def q_join_light_keys_anti(spark, sf_dir):
    p = _p(spark, sf_dir)
    f = p.fact()
    heavy = joins.heavy_keys(f, "customer_id", p.config.heavy_key_threshold)
    return present(joins.light_rows(f, "customer_id", heavy, p.config.max_broadcast_bytes, "sales_id", p.config.salt_buckets))


def q_skew_top_keys(spark, sf_dir):
    return joins.top_keys(_p(spark, sf_dir).fact(), "customer_id", 20, "order_count")


def q_skew_heavy_keys(spark, sf_dir):
    p = _p(spark, sf_dir)
    return joins.heavy_keys(p.fact(), "customer_id", p.config.heavy_key_threshold, "order_count")


HOT_SHARE = 1000


def q_skew_frequent_keys(spark, sf_dir):
    """Customers with more than 1 / ``HOT_SHARE`` of all lines, found in bounded memory."""
    return joins.frequent_keys(_p(spark, sf_dir).fact(), "customer_id", HOT_SHARE, "order_count")


# -- layout ---------------------------------------------------------------------------------

PRUNE_DATE = "2000-12-31"


def q_product_sales_count(spark, sf_dir):
    return layout.count_by(_p(spark, sf_dir).partitioned_fact(), "product_id")


def q_partition_pruned_count(spark, sf_dir):
    fp = _p(spark, sf_dir).partitioned_fact()
    return layout.count_by(fp.filter(layout.date_partition_filter("sales_date", "=", PRUNE_DATE)), "product_id")


def q_dynamic_pruned_months(spark, sf_dir):
    """Sales of the fourth quarters, pruned by the filtered calendar that they are joined with."""
    fact = _p(spark, sf_dir).partitioned_fact()
    months = layout.calendar(fact, "sales_date").filter(F.col("quarter") == 4)
    return layout.join_months(fact, months).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("sales_count"), F.sum("line_total").cast("double").alias("revenue"))


def q_sales_limit(spark, sf_dir):
    return present(_p(spark, sf_dir).fact().orderBy("sales_id").limit(10000))


def q_fact_sales_partitioned(spark, sf_dir):
    return present(_p(spark, sf_dir).partitioned_fact())


def q_layout_partition_counts(spark, sf_dir):
    out = None
    fact = _p(spark, sf_dir).fact()
    for name, df in layout.layouts(fact, "customer_id").items():
        prof = layout.partition_profile(df, name)
        out = prof if out is None else out.unionByName(prof)
    return out


def q_cached_sales_reuse(spark, sf_dir):
    p = _p(spark, sf_dir)
    star = gold.sales_enriched(p.fact(), p.gold_table("dim_customers"), p.gold_table("dim_products"))
    with layout.persisted(star) as cached:  # the second use reads the cached blocks; then they are released
        return present(p.wh.save(cached, "gold", "sales_enriched_cached"))


def q_partition_listing(spark, sf_dir):
    p = _p(spark, sf_dir)
    p.partitioned_fact()
    return layout.partition_listing(spark, p.wh.name("gold", "fact_sales_partitioned"))


def q_table_detail(spark, sf_dir):
    """Rows of the fact before and after the z-order compaction, and whether the compacted
    table has no more files than its size asks for (any count is right before)."""
    p = _p(spark, sf_dir)
    asked = layout.tasks_for(p.fact(), p.sorted_bytes())
    before = layout.file_stats(p.fact()).select(F.lit("fact_sales").alias("table_name"), "num_rows", (F.col("num_files") > 0).alias("within_target"))
    after = layout.file_stats(p.zordered_fact()).select(
        F.lit("fact_sales_zordered").alias("table_name"), "num_rows", F.col("num_files").between(1, asked).alias("within_target"))
    return before.unionByName(after)


def q_zorder_cluster(spark, sf_dir):
    return present(_p(spark, sf_dir).zordered_fact())


# -- snapshots and schema ----------------------------------------------------------------

def q_snapshot_history(spark, sf_dir):
    return _p(spark, sf_dir).fact_snapshots().history(10)


def q_snapshot_counts(spark, sf_dir):
    return _p(spark, sf_dir).fact_snapshots().versions()


def q_snapshot_as_of_version(spark, sf_dir):
    st = _p(spark, sf_dir).fact_snapshots()
    latest = st.latest_version()
    if latest is None or latest < 1:
        raise ValueError("no previous version")
    return present(st.as_of_version(latest - 1))


def q_snapshot_as_of_timestamp(spark, sf_dir):
    return present(_p(spark, sf_dir).fact_snapshots().as_of_timestamp("2024-01-01"))


def q_snapshot_expiry_dry_run(spark, sf_dir):
    p = _p(spark, sf_dir)
    return p.fact_snapshots().expired(p.config.retention_hours, SNAPSHOT_NOW)


def q_snapshot_after_expiry(spark, sf_dir):
    return _p(spark, sf_dir).retained_snapshots().versions()


def q_snapshot_after_expiry_merged(spark, sf_dir):
    """Rows of every version that can still be read after retention, each read through its chain."""
    st = _p(spark, sf_dir).retained_merges()
    out = None
    for v in st.readable():
        n = st.as_of_version(v).agg(F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("num_rows"))
        out = n if out is None else out.unionByName(n)
    return out


# -- files that a read can skip -----------------------------------------------------------

def q_snapshot_changes(spark, sf_dir):
    """What the increment did to the orders: version 0 against version 1."""
    p = _p(spark, sf_dir)
    p.merged("orders")
    return p.silver_versions("orders").changes(0, 1)


def q_silver_reconcile_orders(spark, sf_dir):
    return _p(spark, sf_dir).reconciled_orders()


def q_clustered_sales(spark, sf_dir):
    return present(_p(spark, sf_dir).clustered_sales().rows())


def q_sales_sample_by_state(spark, sf_dir):
    p = _p(spark, sf_dir)
    sales = p.fact().join(p.gold_table("dim_customers").select("customer_id", "state"), "customer_id").select("state", "sales_id", "order_id", "quantity")
    return joins.sample_by_group(sales, "state", "sales_id", 5)


def q_schema_profile(spark, sf_dir):
    p = _p(spark, sf_dir)
    out = None
    for table in ("fact_sales", "dim_customers", "dim_products"):
        df = p.gold_table(table)
        rows = schema.profile(df.select([c for c in df.columns if not c.startswith("record_")]), table)
        out = rows if out is None else out.unionByName(rows)
    return out


POINT = {"customer_id": 7}


def q_silver_merge_bloom_orders(spark, sf_dir):
    return present(_p(spark, sf_dir).indexed_orders().current())


def q_zorder_point_lookup(spark, sf_dir):
    p = _p(spark, sf_dir)
    files = p.zorder_index().files_with(POINT)
    found = skipping.only_files(p.zordered_fact(), files)
    for c, v in POINT.items():
        found = found.filter(F.col(c) == v)
    return present(found)


def q_schema_checked_append(spark, sf_dir):
    return present(_p(spark, sf_dir).products_with_append())


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue by state over the gold star schema built from sf0.001."""
    return q_gold_revenue_by_state(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "bronze_ingest_counts": q_bronze_ingest_counts,
        "bronze_orders": q_bronze_orders,
        "bronze_product_lookup": q_bronze_product_lookup,
        "bronze_quarantine": q_bronze_quarantine,
        "silver_customers_load": _silver_load("customers"),
        "silver_order_items_load": _silver_load("order_items"),
        "silver_orders_load": _silver_load("orders"),
        "silver_products_load": _silver_load("products"),
        "silver_logger_init": q_silver_logger_init,
        "silver_key_check": q_silver_key_check,
        "silver_reject_report": q_silver_reject_report,
        "silver_incremental_orders": q_silver_incremental_orders,
        "silver_orders_two_increments": q_silver_orders_two_increments,
        "silver_orders_two_history": q_silver_orders_two_history,
        **{f"gold_{m}": _mart(m) for m in ("agg_revenue_by_state", "agg_top_products", "agg_daily_sales", "agg_monthly_sales")},
        "silver_customers_merge": _silver_merge("customers"),
        "silver_order_items_merge": _silver_merge("order_items"),
        "silver_orders_merge": _silver_merge("orders"),
        "silver_products_merge": _silver_merge("products"),
        "silver_logger_update": q_silver_logger_update,
        "silver_orders_history": q_silver_orders_history,
        "silver_orders_with_customers": q_silver_orders_with_customers,
        "silver_orders_with_products": q_silver_orders_with_products,
        "gold_dim_customers": _gold_table("dim_customers"),
        "gold_dim_products": _gold_table("dim_products"),
        "gold_fact_sales": _gold_table("fact_sales"),
        "gold_revenue_by_state": q_gold_revenue_by_state,
        "gold_top_products": q_gold_top_products,
        "gold_daily_sales": q_gold_daily_sales,
        "gold_monthly_sales": q_gold_monthly_sales,
        "gold_sales_enriched": q_gold_sales_enriched,
        "gold_revenue_by_state_incremental": q_gold_revenue_by_state_incremental,
        "gold_monthly_from_daily_bitmaps": q_gold_monthly_from_daily_bitmaps,
        "join_fact_customer_auto": q_join_fact_customer_auto,
        "join_fact_customer_broadcast": q_join_fact_customer_broadcast,
        "join_salted": q_join_salted,
        "join_salted_heavy": q_join_salted_heavy,
        "join_split_skew": q_join_split_skew,
        "join_light_keys_anti": q_join_light_keys_anti,
        "skew_top_keys": q_skew_top_keys,
        "skew_heavy_keys": q_skew_heavy_keys,
        "skew_frequent_keys": q_skew_frequent_keys,
        "dynamic_pruned_months": q_dynamic_pruned_months,
        "product_sales_count": q_product_sales_count,
        "partition_pruned_count": q_partition_pruned_count,
        "sales_limit": q_sales_limit,
        "fact_sales_partitioned": q_fact_sales_partitioned,
        "layout_partition_counts": q_layout_partition_counts,
        "cached_sales_reuse": q_cached_sales_reuse,
        "partition_listing": q_partition_listing,
        "table_detail": q_table_detail,
        "zorder_cluster": q_zorder_cluster,
        "snapshot_history": q_snapshot_history,
        "snapshot_counts": q_snapshot_counts,
        "snapshot_as_of_version": q_snapshot_as_of_version,
        "snapshot_as_of_timestamp": q_snapshot_as_of_timestamp,
        "snapshot_expiry_dry_run": q_snapshot_expiry_dry_run,
        "snapshot_after_expiry": q_snapshot_after_expiry,
        "snapshot_after_expiry_merged": q_snapshot_after_expiry_merged,
        "snapshot_changes": q_snapshot_changes,
        "silver_reconcile_orders": q_silver_reconcile_orders,
        "clustered_sales": q_clustered_sales,
        "sales_sample_by_state": q_sales_sample_by_state,
        "schema_profile": q_schema_profile,
        "silver_merge_bloom_orders": q_silver_merge_bloom_orders,
        "zorder_point_lookup": q_zorder_point_lookup,
        "schema_checked_append": q_schema_checked_append,
        **(llm.QUERIES if llm else {}),
    }


# ---------------------------------------------------------------------------------------
# DuckDB oracle

_STAMPS = [("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz")]
# the declared columns of the gold tables
PROFILED = {
    "fact_sales": [("sales_id", "bigint"), ("order_id", "bigint"), ("customer_id", "bigint"), ("product_id", "bigint"), ("sales_date", "date"),
                   ("quantity", "int"), ("unit_price", "decimal(12,2)"), ("line_total", "decimal(23,2)"), ("order_total", "decimal(14,2)"),
                   ("order_status", "string"), *_STAMPS],
    "dim_customers": [("customer_id", "bigint"), ("customer_name", "string"), ("city", "string"), ("state", "string"), ("signup_date", "date"), *_STAMPS],
    "dim_products": [("product_id", "bigint"), ("product_name", "string"), ("category", "string"), ("price", "decimal(12,2)"), *_STAMPS],
}

def _raw(entity: str, cols: list[str], file_name: str) -> str:
    sel = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return (f"SELECT {sel}, {om.RUN_TS} AS ingestion_timestamp, '{file_name}' AS source_file_name "
            f"FROM s_{entity}")


_COLS = {e: [c for c, _ in spec] for e, spec in silver.SPECS.items()}


def _dbl(entity: str, alias: str = "") -> str:
    """Column list of a silver entity with decimals as double."""
    pre = f"{alias}." if alias else ""
    out = []
    for c, t in silver.SPECS[entity]:
        out.append(f"CAST({pre}{c} AS DOUBLE) AS {c}" if t.startswith("decimal") else f"{pre}{c}")
    return ", ".join(out)


def _merge_sql(entity: str) -> str:
    key = silver.KEYS[entity]
    cols = _COLS[entity]
    dec = {c for c, t in silver.SPECS[entity] if t.startswith("decimal")}
    pick = ", ".join(
        (f"CAST(CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS DOUBLE) AS {c}" if c in dec
         else f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}") for c in cols if c != key)
    return om.with_(om.ENTITY_CTES + f""",
first AS (
  SELECT * EXCLUDE (updated_at), CASE WHEN updated_at <= {om.INITIAL_TS} THEN updated_at END AS updated_at,
         {om.INITIAL_TS} AS record_created_at, CAST(NULL AS TIMESTAMP) AS record_updated_at
  FROM s_{entity} WHERE created_at <= {om.INITIAL_TS}),
src AS (SELECT * FROM s_{entity} WHERE created_at > {om.INITIAL_TS} OR updated_at > {om.INITIAL_TS})""",
        f"""SELECT COALESCE(t.{key}, s.{key}) AS {key}, {pick},
  CASE WHEN t.{key} IS NOT NULL THEN t.record_created_at ELSE {om.INCR_TS} END AS record_created_at,
  CASE WHEN t.{key} IS NOT NULL AND s.{key} IS NOT NULL THEN {om.INCR_TS}
       WHEN t.{key} IS NOT NULL THEN t.record_updated_at END AS record_updated_at
FROM first t FULL OUTER JOIN src s ON t.{key} = s.{key}""")


def _mart_sql(group_cols: str, group_by: str, aggs: str, source: str = "fact_sales f") -> str:
    return om.with_(om.GOLD_CTES, f"SELECT {group_cols}, {aggs} FROM {source} GROUP BY {group_by}")


def oracle_sql() -> dict[str, str]:
    raw_files = {"customers": "customers.csv", "order_items": "order_items.csv", "orders": "orders.csv",
                 "products": "products.csv"}
    count_union = " UNION ALL ".join(
        f"SELECT 'raw_{e}' AS target_table, '{f}' AS source_file_name, COUNT(*) AS row_count FROM s_{e}"
        for e, f in raw_files.items())
    sql = {
        "bronze_ingest_counts": om.with_(om.ENTITY_CTES, count_union),
        "bronze_orders": om.with_(om.ENTITY_CTES, _raw("orders", _COLS["orders"], "orders.csv")),
        "bronze_product_lookup": om.with_(
            om.ENTITY_CTES, f"SELECT * FROM ({_raw('products', _COLS['products'], 'products.csv')}) r "
                            "WHERE TRY_CAST(product_id AS BIGINT) = 150"),
    }
    for e in ("customers", "order_items", "orders", "products"):
        sql[f"silver_{e}_load"] = om.with_(
            om.SILVER_CTES, f"SELECT {_dbl(e)}, record_created_at, record_updated_at FROM sv_{e}")
        sql[f"silver_{e}_merge"] = _merge_sql(e)
    short, long = retail.CUT_SHORT, retail.TOO_LONG
    sql["bronze_quarantine"] = om.with_(om.ENTITY_CTES, f"""
SELECT 'orders_damaged.csv' AS source_file_name, CASE WHEN order_id % {short} = 0 THEN 'too few fields'
       WHEN order_id % {long} = 0 THEN 'too many fields' ELSE 'loaded' END AS reason, COUNT(*) AS row_count
FROM s_orders GROUP BY ALL""")
    sql["silver_logger_init"] = om.with_(om.SILVER_CTES, " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, MAX(record_created_at) AS last_run_time FROM sv_{e}"
        for e in ("customers", "products", "orders", "order_items")))
    middle = f"TIMESTAMP '{MIDDLE_TS}'"
    # the second of two increments is for the orders only
    sql["silver_logger_update"] = (
        f"SELECT 'customers' AS table_name, {middle} AS last_run_time UNION ALL SELECT 'orders', {om.INCR_TS}")
    sql["silver_key_check"] = ("SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem "
                               "GROUP BY l_orderkey, l_linenumber "
                               "HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")
    rej = []
    for e, spec in silver.SPECS.items():
        for i, (c, t) in enumerate(spec):
            if t == "string":
                continue
            dt = {"int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}.get(t, t.upper())
            rej.append(f"SELECT '{e}' AS table_name, '{c}' AS column_name, COUNT(*) AS rows_checked, "
                       f"COUNT(CASE WHEN v IS NOT NULL AND TRY_CAST(v AS {dt}) IS NULL THEN 1 END) AS rejected "
                       f"FROM (SELECT CASE WHEN ({silver.KEYS[e]} + {i}) % 50 = 0 THEN '#' || CAST({c} AS VARCHAR) "
                       f"ELSE CAST({c} AS VARCHAR) END AS v FROM s_{e})")
    sql["silver_reject_report"] = om.with_(om.ENTITY_CTES, " UNION ALL ".join(rej))
    sql["silver_orders_history"] = om.with_(om.ENTITY_CTES, f"""
SELECT CAST(0 AS BIGINT) AS version, {om.INITIAL_TS} AS timestamp, 'WRITE' AS operation, COUNT(*) AS num_rows
FROM s_orders WHERE created_at <= {om.INITIAL_TS}
UNION ALL
SELECT CAST(1 AS BIGINT), {om.INCR_TS}, 'MERGE', COUNT(*) FROM
  (SELECT order_id FROM s_orders WHERE created_at <= {om.INITIAL_TS}) t
  FULL OUTER JOIN (SELECT order_id FROM s_orders WHERE created_at > {om.INITIAL_TS} OR updated_at > {om.INITIAL_TS}) s
  ON t.order_id = s.order_id""")
    sql["silver_orders_two_increments"] = om.with_(om.ENTITY_CTES, f"""
SELECT {_dbl('orders')},
  CASE WHEN created_at <= {om.INITIAL_TS} THEN {om.INITIAL_TS} WHEN created_at <= {middle} THEN {middle}
       ELSE {om.INCR_TS} END AS record_created_at,
  CASE WHEN created_at <= {middle} AND updated_at > {middle} THEN {om.INCR_TS}
       WHEN created_at <= {om.INITIAL_TS} AND updated_at > {om.INITIAL_TS} THEN {middle} END AS record_updated_at
FROM s_orders""")
    sql["silver_orders_two_history"] = om.with_(om.ENTITY_CTES, f"""
SELECT CAST(0 AS BIGINT) AS version, {om.INITIAL_TS} AS timestamp, 'WRITE' AS operation,
       (SELECT COUNT(*) FROM s_orders WHERE created_at <= {om.INITIAL_TS}) AS num_rows
UNION ALL SELECT 1, {middle}, 'MERGE', (SELECT COUNT(*) FROM s_orders WHERE created_at <= {middle})
UNION ALL SELECT 2, {om.INCR_TS}, 'MERGE', (SELECT COUNT(*) FROM s_orders)""")
    sql["silver_incremental_orders"] = om.with_(
        om.ENTITY_CTES, f"SELECT {_dbl('orders')} FROM s_orders "
                        f"WHERE created_at > {om.INITIAL_TS} OR updated_at > {om.INITIAL_TS}")
    sql["silver_orders_with_customers"] = om.with_(om.SILVER_CTES, """
SELECT o.order_id, o.order_date, CAST(o.total_amount AS DOUBLE) AS total_amount, o.order_status, c.customer_id,
       c.name AS customer_name, c.city, c.state, c.signup_date
FROM sv_orders o JOIN sv_customers c ON o.customer_id = c.customer_id""")
    sql["silver_orders_with_products"] = om.with_(om.SILVER_CTES, """
SELECT o.order_id, o.order_date, o.order_status, o.customer_id, oi.order_item_id, p.product_id, p.product_name,
       p.category, oi.quantity, CAST(oi.price AS DOUBLE) AS item_price, CAST(oi.quantity * oi.price AS DOUBLE) AS line_total
FROM sv_orders o JOIN sv_order_items oi ON o.order_id = oi.order_id JOIN sv_products p ON oi.product_id = p.product_id""")
    sql["gold_dim_customers"] = om.with_(om.GOLD_CTES, "SELECT * FROM dim_customers")
    sql["gold_dim_products"] = om.with_(
        om.GOLD_CTES, "SELECT * EXCLUDE (price), CAST(price AS DOUBLE) AS price FROM dim_products")
    sql["gold_fact_sales"] = om.with_(om.GOLD_CTES, f"SELECT {om.FACT_COLS} FROM fact_sales")
    sql["gold_revenue_by_state"] = _mart_sql(
        "c.state", "c.state",
        "COUNT(DISTINCT f.order_id) AS total_orders, COUNT(DISTINCT f.customer_id) AS unique_customers, "
        "CAST(SUM(f.line_total) AS DOUBLE) AS total_revenue, "
        "CAST(SUM(f.line_total) AS DOUBLE) / COUNT(f.line_total) AS avg_order_line_value, "
        "CAST(SUM(f.quantity) AS BIGINT) AS total_quantity_sold",
        "fact_sales f JOIN dim_customers c ON f.customer_id = c.customer_id")
    sql["gold_top_products"] = _mart_sql(
        "p.product_id, p.product_name, p.category", "p.product_id, p.product_name, p.category",
        "COUNT(DISTINCT f.order_id) AS times_ordered, CAST(SUM(f.quantity) AS BIGINT) AS total_quantity_sold, "
        "CAST(SUM(f.line_total) AS DOUBLE) AS total_revenue, "
        "CAST(SUM(f.unit_price) AS DOUBLE) / COUNT(f.unit_price) AS avg_unit_price, "
        "CASE WHEN SUM(f.quantity) = 0 THEN NULL ELSE CAST(SUM(f.line_total) AS DOUBLE) / "
        "CAST(SUM(f.quantity) AS DOUBLE) END AS revenue_per_unit",
        "fact_sales f JOIN dim_products p ON f.product_id = p.product_id")
    sql["gold_daily_sales"] = _mart_sql(
        "sales_date", "sales_date",
        "COUNT(DISTINCT order_id) AS daily_orders, COUNT(DISTINCT customer_id) AS daily_customers, "
        "CAST(SUM(line_total) AS DOUBLE) AS daily_revenue, "
        "CAST(SUM(line_total) AS DOUBLE) / COUNT(line_total) AS avg_line_value, "
        "CAST(SUM(quantity) AS BIGINT) AS daily_quantity_sold", "fact_sales")
    sql["gold_monthly_sales"] = _mart_sql(
        "CAST(year(sales_date) AS INTEGER) AS year, CAST(month(sales_date) AS INTEGER) AS month, "
        "CAST(date_trunc('month', sales_date) AS DATE) AS month_start",
        "1, 2, 3",
        "COUNT(DISTINCT order_id) AS monthly_orders, COUNT(DISTINCT customer_id) AS monthly_customers, "
        "CAST(SUM(line_total) AS DOUBLE) AS monthly_revenue, "
        "CAST(SUM(line_total) AS DOUBLE) / COUNT(line_total) AS avg_line_value, "
        "CAST(SUM(quantity) AS BIGINT) AS monthly_quantity_sold", "fact_sales")
    for mart, key in (("agg_revenue_by_state", "revenue_by_state"), ("agg_top_products", "top_products"),
                      ("agg_daily_sales", "daily_sales"), ("agg_monthly_sales", "monthly_sales")):
        sql[f"gold_{mart}"] = sql[f"gold_{key}"]
    sql["gold_sales_enriched"] = om.with_(om.GOLD_CTES, """
SELECT f.sales_id, f.sales_date, c.customer_name, c.state, p.product_name, p.category, f.quantity,
       CAST(f.line_total AS DOUBLE) AS line_total
FROM fact_sales f JOIN dim_customers c ON f.customer_id = c.customer_id
JOIN dim_products p ON f.product_id = p.product_id""")
    sql["cached_sales_reuse"] = sql["gold_sales_enriched"]

    fact_cols = om.FACT_COLS
    plain_join = om.with_(om.GOLD_CTES, f"""
SELECT fc.*, c.customer_name, c.city, c.state, c.signup_date
FROM (SELECT {fact_cols} FROM fact_sales) fc JOIN dim_customers c ON fc.customer_id = c.customer_id""")
    for k in ("join_fact_customer_auto", "join_fact_customer_broadcast", "join_salted", "join_salted_heavy",
              "join_split_skew"):
        sql[k] = plain_join
    heavy = (f"SELECT customer_id FROM fact_sales GROUP BY customer_id "
             f"HAVING COUNT(*) > {se_config().heavy_key_threshold}")
    sql["join_light_keys_anti"] = om.with_(
        om.GOLD_CTES, f"SELECT {fact_cols} FROM fact_sales WHERE customer_id NOT IN ({heavy})")
    sql["skew_top_keys"] = om.with_(om.GOLD_CTES, """
SELECT customer_id, COUNT(*) AS order_count FROM fact_sales GROUP BY customer_id
ORDER BY order_count DESC, customer_id LIMIT 20""")
    sql["skew_heavy_keys"] = om.with_(om.GOLD_CTES, f"""
SELECT customer_id, COUNT(*) AS order_count FROM fact_sales GROUP BY customer_id
HAVING COUNT(*) > {se_config().heavy_key_threshold}""")
    sql["gold_revenue_by_state_incremental"] = sql["gold_revenue_by_state"]
    sql["gold_monthly_from_daily_bitmaps"] = sql["gold_monthly_sales"]
    sql["skew_frequent_keys"] = om.with_(om.GOLD_CTES, f"""
SELECT customer_id, COUNT(*) AS order_count FROM fact_sales WHERE customer_id IS NOT NULL GROUP BY customer_id
HAVING COUNT(*) * {HOT_SHARE} > (SELECT COUNT(customer_id) FROM fact_sales)""")
    sql["dynamic_pruned_months"] = om.with_(om.GOLD_CTES, """
SELECT CAST(year(sales_date) AS INTEGER) AS year, CAST(month(sales_date) AS INTEGER) AS month, COUNT(*) AS sales_count,
       CAST(SUM(line_total) AS DOUBLE) AS revenue
FROM fact_sales WHERE quarter(sales_date) = 4 GROUP BY 1, 2""")
    sql["product_sales_count"] = om.with_(
        om.GOLD_CTES, "SELECT product_id, COUNT(*) AS sales_count FROM fact_sales GROUP BY product_id")
    sql["partition_pruned_count"] = om.with_(om.GOLD_CTES, f"""
SELECT product_id, COUNT(*) AS sales_count FROM fact_sales WHERE sales_date = DATE '{PRUNE_DATE}'
GROUP BY product_id""")
    sql["sales_limit"] = om.with_(om.GOLD_CTES, f"SELECT {fact_cols} FROM fact_sales ORDER BY sales_id LIMIT 10000")
    sql["fact_sales_partitioned"] = om.with_(om.GOLD_CTES, f"""
SELECT {fact_cols}, CAST(year(sales_date) AS INTEGER) AS year, CAST(month(sales_date) AS INTEGER) AS month
FROM fact_sales""")
    sql["layout_partition_counts"] = om.with_(om.GOLD_CTES, """
SELECT layout, CAST(partitions AS BIGINT) AS partitions, n AS rows FROM (SELECT COUNT(*) AS n FROM fact_sales) c,
  (VALUES ('repartition_20', 20), ('repartition_10_by_customer_id', 10), ('coalesce_4_from_20', 4),
          ('coalesce_40_from_20', 20)) v(layout, partitions)""")
    sql["partition_listing"] = om.with_(om.GOLD_CTES, """
SELECT DISTINCT CAST(year(sales_date) AS INTEGER) AS year, CAST(month(sales_date) AS INTEGER) AS month
FROM fact_sales""")
    sql["zorder_cluster"] = sql["gold_fact_sales"]
    snap = om.GOLD_CTES + """,
versions AS (
  SELECT 0 AS version, TIMESTAMP '2024-01-01 00:00:00' AS timestamp, 'CREATE TABLE AS SELECT' AS operation,
         (SELECT COUNT(*) FROM fact_sales WHERE sales_date <= DATE '1998-12-31') AS num_rows
  UNION ALL
  SELECT 1, TIMESTAMP '2024-01-10 00:00:00', 'WRITE',
         (SELECT COUNT(*) FROM fact_sales WHERE sales_date <= DATE '1999-12-31')
  UNION ALL
  SELECT 2, TIMESTAMP '2024-01-20 00:00:00', 'WRITE', (SELECT COUNT(*) FROM fact_sales))"""
    sql["snapshot_history"] = om.with_(
        snap, "SELECT CAST(version AS BIGINT) AS version, timestamp, operation, CAST(num_rows AS BIGINT) AS num_rows "
              "FROM versions ORDER BY version DESC LIMIT 10")
    sql["snapshot_counts"] = om.with_(
        snap, "SELECT CAST(version AS BIGINT) AS version, CAST(num_rows AS BIGINT) AS num_rows FROM versions")
    sql["snapshot_as_of_version"] = om.with_(
        om.GOLD_CTES, f"SELECT {fact_cols} FROM fact_sales WHERE sales_date <= DATE '1999-12-31'")
    sql["snapshot_as_of_timestamp"] = om.with_(
        om.GOLD_CTES, f"SELECT {fact_cols} FROM fact_sales WHERE sales_date <= DATE '1998-12-31'")
    due = f"superseded_at < TIMESTAMP '{SNAPSHOT_NOW}' - INTERVAL {se_config().retention_hours} HOUR"
    superseded = "SELECT *, LEAD(timestamp) OVER (ORDER BY version) AS superseded_at FROM versions"
    sql["snapshot_expiry_dry_run"] = om.with_(snap, f"""
SELECT CAST(version AS BIGINT) AS version, timestamp, superseded_at, CAST(num_rows AS BIGINT) AS num_rows
FROM ({superseded}) h WHERE {due}""")
    # retention is applied to versions of the products
    kept = snap.replace("fact_sales WHERE sales_date <= DATE", "dim_products WHERE created_at <= DATE").replace(
        "(SELECT COUNT(*) FROM fact_sales))", "(SELECT COUNT(*) FROM dim_products))")
    sql["snapshot_after_expiry"] = om.with_(kept, f"""
SELECT CAST(version AS BIGINT) AS version, CAST(num_rows AS BIGINT) AS num_rows
FROM ({superseded}) h WHERE superseded_at IS NULL OR NOT ({due})""")
    # the first chain of merged products is past its time, the second is still read through
    sql["snapshot_after_expiry_merged"] = om.with_(om.ENTITY_CTES, """
SELECT CAST(version AS BIGINT) AS version, COUNT(*) AS num_rows
FROM s_products, (VALUES (2, DATE '1997-12-31'), (3, DATE '1998-12-31'), (4, DATE '1999-12-31'), (5, DATE '1999-12-31')) v(version, day)
WHERE created_at <= day GROUP BY version""")
    changed = ",".join(c for c in _COLS["orders"] if c not in ("order_id", "created_at"))
    sql["snapshot_changes"] = om.with_(om.ENTITY_CTES, f"""
SELECT order_id, CASE WHEN created_at > {om.INITIAL_TS} THEN 'inserted' ELSE 'updated' END AS change,
       CASE WHEN created_at <= {om.INITIAL_TS} THEN '{changed}' END AS changed_columns
FROM s_orders WHERE created_at > {om.INITIAL_TS} OR updated_at > {om.INITIAL_TS}""")
    sql["silver_reconcile_orders"] = om.with_(om.ENTITY_CTES, f"""
SELECT order_id, CASE WHEN order_id % {GONE} = 0 THEN 'missing in source' WHEN order_id % {LOST} = 0 THEN 'missing in target'
                      ELSE 'different' END AS finding
FROM s_orders WHERE (order_id % {GONE} = 0) <> (order_id % {LOST} = 0) OR (order_id % {LATE} = 0 AND order_id % {GONE} <> 0)""")
    sql["clustered_sales"] = om.with_(om.GOLD_CTES, f"SELECT {fact_cols} FROM fact_sales")
    sql["sales_sample_by_state"] = om.with_(om.GOLD_CTES, """
SELECT state, sales_id, order_id, quantity FROM fact_sales f JOIN dim_customers c ON f.customer_id = c.customer_id
QUALIFY row_number() OVER (PARTITION BY state ORDER BY md5(CAST(sales_id AS VARCHAR)), sales_id) <= 5""")
    prof = []
    for table, cols in PROFILED.items():
        for i, (c, kind) in enumerate(cols):
            prof.append(f"SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, COUNT(*) AS num_rows, "
                        f"COUNT(*) - COUNT({c}) AS nulls, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value FROM {table}")
    sql["schema_profile"] = om.with_(om.GOLD_CTES, " UNION ALL ".join(prof))
    sql["silver_merge_bloom_orders"] = sql["silver_orders_merge"]
    point = " AND ".join(f"{c} = {v}" for c, v in POINT.items())
    sql["zorder_point_lookup"] = om.with_(om.GOLD_CTES, f"SELECT {fact_cols} FROM fact_sales WHERE {point}")
    sql["table_detail"] = om.with_(om.GOLD_CTES, """
SELECT table_name, COUNT(*) AS num_rows, true AS within_target
FROM fact_sales, (VALUES ('fact_sales'), ('fact_sales_zordered')) v(table_name) GROUP BY table_name""")
    sql["schema_checked_append"] = om.with_(om.GOLD_CTES, f"""
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, created_at, updated_at,
       record_created_at, record_updated_at FROM dim_products
UNION ALL
SELECT product_id, product_name, category, CAST(price AS DOUBLE), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP),
       CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)
FROM s_products WHERE created_at > {om.INITIAL_TS} OR updated_at > {om.INITIAL_TS}""")
    return sql | (llm.ORACLES if llm else {})


def se_config():
    from strata.config import Config
    return Config()
