"""Gold layer: star schema (two dimensions, one fact) and the business marts.

Marts are declarative aggregations; Catalyst plans the several exact
``count(distinct)`` per group as Expand + partial/final HashAggregate, which
spreads a hot group over many tasks (the distinct keys, not the group, drive
the shuffle). Averages are sum / count over exact decimal sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.expressions import as_double, month_start, ratio

AUDIT = ["created_at", "updated_at", "record_created_at", "record_updated_at"]


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", F.col("name").alias("customer_name"), "city", "state", "signup_date", *AUDIT)


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "price", *AUDIT)


def fact_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order line; audit columns and ``order_total`` come from the order
    (``order_total`` repeats per line, so no mart sums it)."""
    o = orders.select("order_id", "customer_id", F.col("order_date").alias("sales_date"),
                      F.col("total_amount").alias("order_total"), "order_status", *AUDIT)
    i = items.select(F.col("order_item_id").alias("sales_id"), "order_id", "product_id", "quantity",
                     F.col("price").alias("unit_price"))
    return o.join(i, "order_id").select(
        "sales_id", "order_id", "customer_id", "product_id", "sales_date", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
        "order_total", "order_status", *AUDIT)


def order_totals(fact: DataFrame) -> DataFrame:
    """The fact reduced to (sales_date, customer_id, order_id): revenue, counted lines, quantity.

    Partial aggregation runs before any shuffle. State, day and month marts build on it:
    every distinct order and customer survives as its own row, and sums and counts add
    up, so distinct counts expand orders instead of lines.
    """
    return fact.groupBy("sales_date", "customer_id", "order_id").agg(
        F.sum("line_total").alias("revenue"), F.count("line_total").alias("lines"), F.sum("quantity").alias("quantity"))


def state_revenue(totals: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Revenue per customer state from :func:`order_totals`; the join moves orders, not lines."""
    return (totals.join(dim_cust.select("customer_id", "state"), "customer_id")
            .groupBy("state")
            .agg(F.countDistinct("order_id").alias("total_orders"),
                 F.countDistinct("customer_id").alias("unique_customers"),
                 as_double(F.sum("revenue")).alias("total_revenue"),
                 ratio(F.sum("revenue"), F.sum("lines")).alias("avg_order_line_value"),
                 F.sum("quantity").alias("total_quantity_sold")))


def revenue_by_state(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    return state_revenue(order_totals(fact), dim_cust)


def top_products(fact: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Per-product sales with the product's name and category.

    Eager aggregation: the fact is aggregated per product before the join, so the
    join moves one row per product instead of every line. Exact for any dimension:
    when several identical dimension rows match, the original sums grow with the
    match count while the distinct order count does not, which ``sum`` / ``max``
    of the per-product rows reproduce.
    """
    per_product = fact.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("_orders"), F.sum("quantity").alias("_qty"),
        F.sum("line_total").alias("_rev"), F.sum("unit_price").alias("_price"),
        F.count("unit_price").alias("_n_price"))
    return (per_product.join(dim_prod.select("product_id", "product_name", "category"), "product_id")
            .groupBy("product_id", "product_name", "category")
            .agg(F.max("_orders").alias("times_ordered"),
                 F.sum("_qty").alias("total_quantity_sold"),
                 as_double(F.sum("_rev")).alias("total_revenue"),
                 ratio(F.sum("_price"), F.sum("_n_price")).alias("avg_unit_price"),
                 ratio(F.sum("_rev"), F.sum("_qty")).alias("revenue_per_unit")))


def _sales(prefix: str) -> list:
    return [F.countDistinct("order_id").alias(f"{prefix}_orders"),
            F.countDistinct("customer_id").alias(f"{prefix}_customers"),
            as_double(F.sum("revenue")).alias(f"{prefix}_revenue"),
            ratio(F.sum("revenue"), F.sum("lines")).alias("avg_line_value"),
            F.sum("quantity").alias(f"{prefix}_quantity_sold")]


def by_day(totals: DataFrame) -> DataFrame:
    return totals.groupBy("sales_date").agg(*_sales("daily"))


def by_month(totals: DataFrame) -> DataFrame:
    return totals.groupBy(F.year("sales_date").alias("year"), F.month("sales_date").alias("month"),
                          month_start("sales_date").alias("month_start")).agg(*_sales("monthly"))


def daily_sales(fact: DataFrame) -> DataFrame:
    return by_day(order_totals(fact))


def monthly_sales(fact: DataFrame) -> DataFrame:
    return by_month(order_totals(fact))


def sales_enriched(fact: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Star join fact -> customers -> products (the reference's 'expensive' query)."""
    f = fact.select("sales_id", "sales_date", "customer_id", "product_id", "quantity", "line_total")
    return (f.join(dim_cust.select("customer_id", "customer_name", "state"), "customer_id")
            .join(dim_prod.select("product_id", "product_name", "category"), "product_id")
            .select("sales_id", "sales_date", "customer_name", "state", "product_name", "category",
                    "quantity", "line_total"))


# Read-time order of each mart (CTAS ordering is not a contract, so order at read);
# a key column breaks ties so the order is total.
MART_ORDER = {
    "agg_revenue_by_state": [("total_revenue", False), ("state", True)],
    "agg_top_products": [("total_revenue", False), ("product_id", True)],
    "agg_daily_sales": [("sales_date", False)],
    "agg_monthly_sales": [("year", False), ("month", False)],
}


def ordered(df: DataFrame, mart: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in MART_ORDER[mart]])
