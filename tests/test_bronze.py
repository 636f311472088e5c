from pyspark.sql import types as T

from strata.sources import bronze, retail


def test_config_ingest_and_audit_columns(spark, wh):
    src = retail.as_raw(retail.orders(spark, "/root/testdata/sf0.001"))
    cfg = bronze.land_raw(wh, {"orders": src})
    conf = bronze.read_config(spark, cfg).collect()
    assert [r["TargetTableName"] for r in conf] == ["raw_orders"]
    tables = bronze.ingest(wh, cfg, "2002-01-01 00:00:00")
    df = spark.table(tables["raw_orders"])
    assert df.count() == src.count()
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    assert all(isinstance(types[c], T.StringType) for c in src.columns)
    assert isinstance(types["ingestion_timestamp"], T.TimestampNTZType)
    assert {r[0] for r in df.select("source_file_name").distinct().collect()} == {"orders.csv"}
    # the CSV round trip keeps NULL as NULL and every value as text
    assert df.exceptAll(bronze.stamp(src, "orders.csv", "2002-01-01 00:00:00")).count() == 0


def test_lookup_implicit_int(spark):
    df = spark.createDataFrame([("150",), ("0150",), ("15",), ("abc",), (None,)], "product_id string")
    assert sorted(r[0] for r in bronze.lookup(df, "product_id", 150).collect()) == ["0150", "150"]


def test_file_name():
    assert bronze.file_name("/a/b/raw_data/customers.csv") == "customers.csv"
    assert bronze.file_name("/a/b/raw_data/customers.csv/") == "customers.csv"


def test_lookup_pushes_an_implied_predicate(spark, wh):
    from strata.plans.inspect import plan_text
    path = f"{wh.root}/lookup.parquet"
    spark.createDataFrame([("150",), ("0150",), ("15",), ("abc",)], "product_id string").write.parquet(path)
    df = bronze.lookup(spark.read.parquet(path), "product_id", 150)
    assert "StringContains(product_id,150)" in plan_text(df)
    assert sorted(r[0] for r in df.collect()) == ["0150", "150"]


def test_broken_lines_are_set_apart(spark, wh):
    lines = ["a,b,c", "1,x,2", "2,y", "3,z,4,5", '4,"q,r",6', '5,"q', "", "6,,"]
    path = f"{wh.root}/raw_data/broken.csv"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, bad = bronze.load_guarded(wh, path, "raw_broken", ["a", "b", "c"], "2002-01-01 00:00:00")
    assert sorted((r.a, r.b, r.c) for r in good.collect()) == [("1", "x", "2"), ("4", "q,r", "6"), ("6", None, None)]
    assert {(r.line, r.reason) for r in bad.collect()} == {("2,y", "too few fields"), ("3,z,4,5", "too many fields"), ('5,"q', "open quote")}
    assert {r.source_file_name for r in bad.collect()} == {"broken.csv"} and good.columns[-2:] == ["ingestion_timestamp", "source_file_name"]
    # a count of either side alone is right as well, although it needs no column
    assert good.count() == 3 and bad.count() == 3
