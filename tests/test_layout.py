import re
from types import SimpleNamespace

from pyspark.sql import functions as F

import __spark_entry__ as se
from strata.config import Config
from strata.operators import layout
from strata.plans.inspect import plan_text


def test_partitioned_fact_and_listing(medallion, spark):
    fp = medallion.partitioned_fact()
    assert fp.count() == medallion.fact().count()
    listing = layout.partition_listing(spark, medallion.wh.name("gold", "fact_sales_partitioned"))
    expected = medallion.fact().select(F.year("sales_date").alias("year"), F.month("sales_date").alias("month")).distinct()
    assert listing.exceptAll(expected).count() == 0 and expected.exceptAll(listing).count() == 0


def test_derived_predicates_prune_partitions(medallion):
    fp = medallion.partitioned_fact()
    day = fp.select("sales_date").first()[0]
    plain = fp.filter(F.col("sales_date") == F.lit(day))
    pruned = fp.filter(layout.date_partition_filter("sales_date", "=", day))
    assert pruned.count() == plain.count()
    txt = plan_text(pruned)
    m = re.search(r"PartitionFilters: \[(.*?)\]", txt)
    assert m and "year" in m.group(1) and "month" in m.group(1)
    assert re.search(r"PartitionFilters: \[\]", plan_text(plain)) or "PartitionFilters" not in plan_text(plain)


def test_range_predicates_exact(medallion):
    fp = medallion.partitioned_fact()
    for op, a, b in ((">=", "1997-03-15", None), ("<", "1996-07-01", None), ("between", "1996-02-10", "1998-11-20"),
                     (">", "2000-12-31", None), ("<=", "1995-01-31", None)):
        c = F.col("sales_date")
        base = {"<": c < a, "<=": c <= a, ">": c > a, ">=": c >= a}.get(op)
        if op == "between":
            base = c.between(a, b)
        assert fp.filter(layout.date_partition_filter("sales_date", op, a, b)).count() == fp.filter(base).count()


def test_repartition_and_coalesce_keep_rows(medallion):
    f = medallion.fact()
    n = f.count()
    got = {r["layout"]: (r["partitions"], r["rows"]) for name, df in layout.layouts(f, "customer_id").items()
           for r in layout.partition_profile(df, name).collect()}
    assert got["repartition_20"] == (20, n)
    assert got["coalesce_4_from_20"] == (4, n)
    assert got["coalesce_40_from_20"] == (20, n)       # coalesce cannot grow
    assert got["repartition_10_by_customer_id"][1] == n


def test_layout_counts_are_the_same_at_every_size(spark, wh, monkeypatch):
    """A fact worth many files of the target size gets the layouts that the result names."""
    fact = wh.save(spark.range(3000).selectExpr("id AS sales_id", "id % 700 AS customer_id"), "gold", "layout_sales")
    config = Config(target_file_bytes=256)
    assert layout.tasks_for(fact, config.target_file_bytes) > 20
    monkeypatch.setattr(se, "_p", lambda *_: SimpleNamespace(fact=lambda: fact, config=config))
    got = {r["layout"]: (r["partitions"], r["rows"]) for r in se.q_layout_partition_counts(spark, "").collect()}
    assert got == {"repartition_20": (20, 3000), "repartition_10_by_customer_id": (10, 3000),
                   "coalesce_4_from_20": (4, 3000), "coalesce_40_from_20": (20, 3000)}


def test_persisted_reads_cache(medallion):
    f = medallion.fact()
    with layout.persisted(f.groupBy("customer_id").count()) as df:
        assert "InMemoryTableScan" in plan_text(df)
        assert df.storageLevel.useDisk and df.storageLevel.useMemory
    assert not df.storageLevel.useDisk and not df.storageLevel.useMemory   # released


def test_partition_listing_with_rows_without_a_date(spark, wh):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.date(2001, 2, 3)), (2, None)], "id bigint, d date")
    layout.write_partitioned(wh, df, "gold", "dated", "d")
    got = {tuple(r) for r in layout.partition_listing(spark, wh.name("gold", "dated")).collect()}
    assert got == {(2001, 2), (None, None)}


def test_zorder_takes_text_columns(spark):
    df = spark.range(400).selectExpr("id", "concat(char(97 + id % 26), id) AS name")
    z = layout.zorder_cluster(df, ["id", "name"], 4, bits=4)
    assert z.exceptAll(df).count() == 0 and z.count() == 400


def test_file_stats(medallion):
    st = layout.file_stats(medallion.fact()).first()
    assert st["num_rows"] == medallion.fact().count() and st["num_files"] >= 1 and st["size_in_bytes"] > 0


def test_zorder_keeps_rows_and_narrows_files(spark, medallion):
    f = medallion.fact().repartition(16)  # unclustered input, 16 files
    cols = ["customer_id", "product_id", "sales_date"]
    z = layout.zorder_cluster(f, cols, 16)
    assert z.exceptAll(f).count() == 0 and f.exceptAll(z).count() == 0
    base = medallion.wh.root + "/scratch_zorder"
    f.write.mode("overwrite").parquet(base + "/plain")
    z.write.mode("overwrite").parquet(base + "/z")
    plain_r = layout.file_ranges(spark.read.parquet(base + "/plain"), cols).collect()
    z_r = layout.file_ranges(spark.read.parquet(base + "/z"), cols).collect()
    probes = f.select(*cols).orderBy("sales_id").limit(40).collect()

    def candidates(ranges, c):
        # files a point filter on column c must open, summed over the probe points
        return sum(r[f"{c}_min"] <= p[c] <= r[f"{c}_max"] for p in probes for r in ranges)

    for c in cols:
        assert candidates(z_r, c) < candidates(plain_r, c), c
