import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import silver

T0 = dt.datetime(1999, 1, 1)
ITEM_COLS = ["order_item_id", "order_id", "product_id", "quantity", "price", "created_at", "updated_at"]


def ts(s):
    return dt.datetime.fromisoformat(s)


def _items(spark, rows, audit=True):
    schema = ("order_item_id int, order_id int, product_id int, quantity int, price decimal(12,2), "
              "created_at timestamp_ntz, updated_at timestamp_ntz")
    if audit:
        schema += ", record_created_at timestamp_ntz, record_updated_at timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def test_upsert_paths(spark):
    from decimal import Decimal as D
    target = _items(spark, [
        (1, 10, 100, 1, D("1.00"), ts("1998-01-01"), None, T0, None),   # updated
        (2, 10, 101, 2, D("2.00"), ts("1998-01-02"), None, T0, None),   # untouched
    ])
    source = _items(spark, [
        (1, 10, 100, 5, D("9.99"), ts("1998-01-01"), ts("1999-06-01")),  # matched
        (3, 11, 102, 1, D("3.00"), ts("1999-02-01"), None),               # inserted (product_id kept: D1)
        (None, 12, 103, 1, D("4.00"), ts("1999-03-01"), None),            # NULL key never matches
    ], audit=False)
    out = {r["order_item_id"]: r for r in silver.upsert(target, source, "order_item_id", "2002-01-01 00:00:00").collect()}
    assert len(out) == 4
    assert out[1]["quantity"] == 5 and out[1]["price"] == D("9.99")
    assert out[1]["record_created_at"] == T0 and out[1]["record_updated_at"] == ts("2002-01-01")
    assert out[2]["quantity"] == 2 and out[2]["record_updated_at"] is None
    assert out[3]["product_id"] == 102 and out[3]["record_created_at"] == ts("2002-01-01")
    assert out[3]["record_updated_at"] is None
    assert out[None]["order_id"] == 12


def test_upsert_twice_is_idempotent_on_business_columns(spark):
    from decimal import Decimal as D
    target = _items(spark, [(1, 10, 100, 1, D("1.00"), ts("1998-01-01"), None, T0, None)])
    source = _items(spark, [(1, 10, 100, 7, D("1.50"), ts("1998-01-01"), ts("1999-05-05")),
                            (2, 10, 100, 1, D("1.00"), ts("1999-05-05"), None)], audit=False)
    once = silver.upsert(target, source, "order_item_id", "2002-01-01 00:00:00")
    twice = silver.upsert(once, source, "order_item_id", "2002-01-02 00:00:00")
    cols = ITEM_COLS
    assert once.select(cols).exceptAll(twice.select(cols)).count() == 0
    assert twice.select(cols).exceptAll(once.select(cols)).count() == 0


def test_upsert_duplicate_source_rows_fail(spark):
    from decimal import Decimal as D
    target = _items(spark, [(1, 10, 100, 1, D("1.00"), ts("1998-01-01"), None, T0, None)])
    source = _items(spark, [(1, 10, 100, 2, D("1.00"), ts("1999-01-02"), None),
                            (1, 10, 100, 3, D("1.00"), ts("1999-01-03"), None)], audit=False)
    with pytest.raises(Exception, match="MERGE conflict"):
        silver.upsert(target, source, "order_item_id", "2002-01-01 00:00:00").collect()
    # the guard is a row filter: reading only the key, or counting, does not prune it
    with pytest.raises(Exception, match="MERGE conflict"):
        silver.upsert(target, source, "order_item_id", "2002-01-01 00:00:00").select("order_item_id").collect()
    with pytest.raises(Exception, match="MERGE conflict"):
        silver.upsert(target, source, "order_item_id", "2002-01-01 00:00:00").count()


def test_duplicate_unmatched_source_rows_are_both_inserted(spark):
    from decimal import Decimal as D
    target = _items(spark, [(1, 10, 100, 1, D("1.00"), ts("1998-01-01"), None, T0, None)])
    source = _items(spark, [(5, 10, 100, 2, D("1.00"), ts("1999-01-02"), None),
                            (5, 10, 100, 3, D("1.00"), ts("1999-01-03"), None)], audit=False)
    assert silver.upsert(target, source, "order_item_id", "2002-01-01 00:00:00").count() == 3


def test_changed_since_three_valued_or_and_null_mark(spark):
    df = spark.createDataFrame([
        (1, ts("1998-01-01"), None),               # old, never updated -> out
        (2, ts("1998-01-01"), ts("1999-06-01")),   # updated after the mark -> in
        (3, ts("1999-02-01"), None),               # created after the mark, NULL update -> in
        (4, None, ts("1999-02-01")),               # NULL create does not hide a true update -> in
    ], "id int, created_at timestamp_ntz, updated_at timestamp_ntz")
    got = sorted(r.id for r in silver.changed_since(df, T0).collect())
    assert got == [2, 3, 4]
    assert silver.changed_since(df, None).count() == 4


def test_logger_init_update_and_mark(spark):
    a = spark.createDataFrame([(ts("2001-01-01"),), (ts("2001-02-01"),)], "record_created_at timestamp_ntz")
    empty = spark.createDataFrame([], "record_created_at timestamp_ntz")
    log = silver.logger_init({"a": a, "b": empty})
    assert silver.read_mark(log, "a") == ts("2001-02-01")
    assert silver.read_mark(log, "b") is None   # empty first load: NULL mark = load everything
    log2 = silver.logger_update(log, "b", "2002-01-01 00:00:00")
    assert silver.read_mark(log2, "b") == ts("2002-01-01")
    assert silver.read_mark(log2, "a") == ts("2001-02-01")


def test_reject_report_and_strict_load(spark):
    raw = spark.createDataFrame([
        ("1", "10", "2000-01-05", "12.50", "F", "2000-01-05 00:00:00", None),
        ("x", "10", "2000-01-05", "12.50", "F", "2000-01-05 00:00:00", None),        # bad int
        ("3", "10", "2000-13-45", "12.50", "F", "2000-01-05 00:00:00", None),        # bad date
        ("4", "10", "2000-01-05", "twelve", "F", "2000-01-05 00:00:00", None),       # bad amount
        ("5", "10", "2000-01-05", "12.50", "F", "yesterday", None),                  # bad timestamp
    ], "order_id string, customer_id string, order_date string, total_amount string, order_status string, "
       "created_at string, updated_at string")
    rej = {r["order_id"]: r["rejected_columns"] for r in silver.reject_rows(raw, "orders").collect()}
    assert rej == {"x": ["order_id"], "3": ["order_date"], "4": ["total_amount"], "5": ["created_at"]}
    summary = {r["column_name"]: (r["rows_checked"], r["rejected"])
               for r in silver.reject_summary(raw, "orders").collect()}
    assert summary["order_id"] == (5, 1) and summary["updated_at"] == (5, 0)
    with pytest.raises(Exception):
        silver.full_load(raw, "orders", "2002-01-01 00:00:00").collect()
    good = raw.filter(F.col("order_id") == "1")
    row = silver.full_load(good, "orders", "2002-01-01 00:00:00").first()
    assert row["order_id"] == 1 and str(row["total_amount"]) == "12.50"


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    got = sorted((r.a, r.b, r.row_count) for r in silver.key_check(df, ["a", "b"]).collect()
                 if r.a is not None)
    assert got == [(1, 1, 2)]
    assert silver.key_check(df, ["a", "b"]).count() == 2


def test_silver_counts(medallion):
    assert medallion.silver_table("order_items").count() == medallion.raw("order_items").count()
    keys = medallion.silver_table("order_items")
    assert silver.key_check(keys, "order_item_id").count() == 0
