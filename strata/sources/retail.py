"""The retail model (customers, products, orders, order items) over the given tables.

The reference ingests four raw CSV extracts that are not shipped with it; this
module derives the same four entities from the TPC-H-style parquet tables, with
the same rules the DuckDB oracle uses, so every later layer runs on data whose
size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.expressions import days_after, money, ntz

ENTITIES = ("customers", "products", "orders", "order_items")

# Fixed values of the fixture model (must equal the oracle's):
#   customers  created = 1994-01-01 + (custkey * 7 % 2500) days, updated 400 days later when custkey % 7 = 0
#   products   created = 1995-01-01 + (partkey * 3 % 2000) days, updated 300 days later when p_size > 40
#   orders     updated 30 days after the order date when status = 'F'
#   items      updated 60 days after the ship date when returnflag = 'R'; id = orderkey * 100 + line rank
CUSTOMER_EPOCH = "1994-01-01 00:00:00"
PRODUCT_EPOCH = "1995-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")  # 25 rows: the planner broadcasts it by size
    created = days_after(ntz(CUSTOMER_EPOCH), (F.col("c_custkey") * 7 % 2500).cast("int"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .select(
            F.col("c_custkey").cast("bigint").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat_ws("-", "n_name", "c_mktsegment").alias("city"),
            F.col("n_name").alias("state"),
            created.alias("created_at"),
            F.col("c_custkey").alias("_k"),
        )
        .select(
            "customer_id", "name", "city", "state",
            F.col("created_at").cast("date").alias("signup_date"),
            "created_at",
            F.when(F.col("_k") % 7 == 0, days_after("created_at", 400)).alias("updated_at"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    created = days_after(ntz(PRODUCT_EPOCH), (F.col("p_partkey") * 3 % 2000).cast("int"))
    return p.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category"),
        money("p_retailprice").alias("price"),
        created.alias("created_at"),
        F.when(F.col("p_size") > 40, days_after(created, 300)).alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("bigint").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        money("o_totalprice", 14).alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", days_after("o_orderdate", 30)).alias("updated_at"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a surrogate key: the (orderkey, linenumber) pair repeats in the data.

    The rank is a window per order; orders are small groups, so the window never holds
    a big one. The id has room for 99 lines an order; a longer order is an error, as its
    ids would be those of the next order.
    """
    li = read_table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    rank = F.row_number().over(w)
    line = F.when(rank < 100, rank).otherwise(F.raise_error(F.concat(
        F.lit("more than 99 lines in order "), F.col("l_orderkey").cast("string"))).cast("int"))
    return li.select(
        (F.col("l_orderkey") * 100 + line).cast("bigint").alias("order_item_id"),
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("created_at"),
        F.when(F.col("l_returnflag") == "R", days_after("l_shipdate", 60)).alias("updated_at"),
    )


BUILDERS = {"customers": customers, "products": products, "orders": orders, "order_items": order_items}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


def as_raw(df: DataFrame) -> DataFrame:
    """Every column as text, the way a CSV extract carries it."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def as_dirty_raw(df: DataFrame, key: str) -> DataFrame:
    """The text extract with damage in every typed column: the value of column number i
    (from 0) has a ``#`` in front where key + i is a multiple of 50."""
    raw = []
    for i, f in enumerate(df.schema.fields):
        text = F.col(f.name).cast("string")
        if f.dataType.simpleString() != "string":
            text = F.when((F.col(key) + i) % 50 == 0, F.concat(F.lit("#"), text)).otherwise(text)
        raw.append(text.alias(f.name))
    return df.select(raw)


# fixed values of the damaged extract: keys whose line is cut short, or has a field too many
CUT_SHORT, TOO_LONG = 89, 83


def damaged_lines(df: DataFrame, key: str) -> DataFrame:
    """The extract as CSV lines (no header), some of them broken: two fields short or one too many."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    whole = F.concat_ws(",", *fields)
    return df.select(F.when(F.col(key) % CUT_SHORT == 0, F.concat_ws(",", *fields[:-2]))
                     .when(F.col(key) % TOO_LONG == 0, F.concat(whole, F.lit(",x"))).otherwise(whole).alias("value"))


def as_of(df: DataFrame, ts: str, key: str) -> DataFrame:
    """The extract as it looked at ``ts``: rows created by then, later updates not yet made.

    A row that is updated later still has its old values then: text is marked as old,
    numbers are one less, dates a day earlier. A merge must overwrite all of them.
    """
    t = ntz(ts)
    later = F.col("updated_at") > t
    early = df.filter(F.col("created_at") <= t)
    for f in df.schema.fields:
        c = F.col(f.name)
        kind = f.dataType.simpleString()
        if f.name in (key, "created_at", "updated_at"):
            continue
        old = F.concat(F.lit("old "), c) if kind == "string" else F.date_sub(c, 1) if kind == "date" else (c - 1).cast(kind)
        early = early.withColumn(f.name, F.when(later, old).otherwise(c))
    return early.withColumn("updated_at", F.when(F.col("updated_at") <= t, F.col("updated_at")))
