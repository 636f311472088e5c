"""Marts kept up to date by signed deltas, and distinct counts that can be merged.

An order is the unit of change: whatever a run changes in orders, lines or customers, the
old rows of the orders concerned are retracted (sign -1) and their new rows added (+1). An
order belongs to one customer at a time, so distinct orders of any group of customers
add up; distinct customers need to know when a customer's last order goes, so each
customer's number of orders (its multiplicity) is stored. A run shuffles and writes what
changed: rows of changed orders, stored rows of the customers they touch, and the mart. The
lines' last two versions are read once, by bucket, and move by order once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expressions import as_double, month_start, ntz, ratio
from strata.operators.snapshots import SnapshotTable
from strata.sources.tables import Warehouse

MEASURES = ("orders", "revenue", "lines", "quantity")


def order_contributions(orders: DataFrame, items: DataFrame) -> DataFrame:
    """(order_id, customer_id, orders, revenue, lines, quantity) of every order with a line."""
    lines = items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("price")).alias("revenue"), F.count(F.col("quantity") * F.col("price")).alias("lines"), F.sum("quantity").alias("quantity"))
    return orders.select("order_id", "customer_id").join(lines, "order_id").select(
        "order_id", "customer_id", F.lit(1).cast("long").alias("orders"), F.col("revenue").cast("decimal(38,2)").alias("revenue"), "lines", "quantity")


def by_customer(contributions: DataFrame) -> DataFrame:
    """Contributions summed by customer; a null customer joins no dimension row and is left out."""
    zero = {"orders": "bigint", "revenue": "decimal(38,2)", "lines": "bigint", "quantity": "bigint"}
    return contributions.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast(t).alias(m) for m, t in zero.items()])


def signed_contributions(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Contributions of two versions' orders (``now``: the newer one's), the older one's negative.

    ``items`` are the lines of both with their ``_side``, so that the lines move by order once
    for both versions: an order's row has its sums before and after."""
    amount = F.col("quantity") * F.col("price")
    sums = []
    for side, there in (("old", F.col("_side") != 2), ("new", F.col("_side") != 1)):
        sums += [F.max(there).alias(f"in_{side}"), F.sum(F.when(there, amount)).cast("decimal(38,2)").alias(f"revenue_{side}"),
                 F.count(F.when(there, amount)).alias(f"lines_{side}"), F.sum(F.when(there, F.col("quantity"))).alias(f"quantity_{side}")]
    both = orders.join(items.groupBy("order_id").agg(*sums), "order_id")
    now = F.col("now")
    measures = [F.when(now, F.col(f"{m}_new")).otherwise((-F.col(f"{m}_old")).cast(both.schema[f"{m}_old"].dataType)).alias(m) for m in MEASURES[1:]]
    return both.filter(F.when(now, F.col("in_new")).otherwise(F.col("in_old"))).select(
        "order_id", "customer_id", F.when(now, 1).otherwise(-1).cast("long").alias("orders"), *measures)


def state_sums(rows: DataFrame, prefix: str, sign: int) -> DataFrame:
    """(state, total_orders, unique_customers, revenue, lines, quantity) of customers' rows, signed.

    Customers that no dimension row knows, or without an order, count for no state."""
    n = F.lit(sign)
    return rows.filter(F.col(f"{prefix}known") & (F.col(f"{prefix}orders") > 0)).select(
        F.col(f"{prefix}state").alias("state"), (F.col(f"{prefix}orders") * n).alias("total_orders"), n.cast("long").alias("unique_customers"),
        *[(F.col(f"{prefix}{m}") * n).cast("decimal(38,2)" if m == "revenue" else "long").alias(m) for m in MEASURES[1:]])


def state_totals(parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast("decimal(38,2)" if c == "revenue" else "long").alias(c) for c in ("total_orders", "unique_customers", *MEASURES[1:])]
    return parts.groupBy("state").agg(*sums).filter(F.col("total_orders") > 0)


def state_mart(totals: DataFrame) -> DataFrame:
    """The revenue-by-state mart out of stored totals."""
    return totals.select("state", "total_orders", "unique_customers", as_double(F.col("revenue")).alias("total_revenue"),
                         ratio(F.col("revenue"), F.col("lines")).alias("avg_order_line_value"), F.col("quantity").alias("total_quantity_sold"))


class StateRevenue:
    """Revenue by state, kept up to date.

    ``<name>_customers`` holds a row for each customer: state, multiplicity (orders) and
    sums; ``<name>_totals`` the mart's sums by state. Both are versioned."""

    def __init__(self, wh: Warehouse, name: str, buckets: int):
        self.wh, self.name = wh, name
        self.customers = SnapshotTable(wh, "gold", f"{name}_customers", bucket_by=(buckets, "customer_id"), index=["customer_id"])
        self.totals = SnapshotTable(wh, "gold", f"{name}_totals")

    def drop(self) -> None:
        self.customers.drop()
        self.totals.drop()

    def build(self, orders: DataFrame, items: DataFrame, customers: DataFrame, ts: str) -> None:
        """The first load: the only step that reads whole tables."""
        rows = by_customer(order_contributions(orders, items)).join(customers.select("customer_id", "state", F.lit(True).alias("known")), "customer_id", "left")
        self.customers.commit(rows.select("customer_id", "state", F.coalesce("known", F.lit(False)).alias("known"), *MEASURES, ntz(ts).alias("since")), ts)
        self.totals.commit(state_totals(state_sums(self.customers.current(), "", 1)), ts)

    def changed_orders(self, items: SnapshotTable, order_changes: DataFrame, item_changes: DataFrame) -> DataFrame:
        """(order_id) of all orders that a run has changed, lines moved between orders included."""
        log = items.log()
        left = items.current_of_keys(item_changes, log, version=log[-2]["version"]).select("order_id")
        ids = order_changes.select("order_id").unionByName(item_changes.select("order_id")).unionByName(left)
        return self.wh.save(ids.filter(F.col("order_id").isNotNull()).distinct(), "gold", f"{self.name}_changed_orders")

    def delta(self, ids: DataFrame, orders: SnapshotTable, items: SnapshotTable) -> DataFrame:
        """What the given orders add to their customers (one row a customer): the contributions
        of the latest version less those of the one before."""
        o, i = orders.log(), items.log()
        before, after = (orders.current_of_keys(ids, o, version=o[k]["version"]).select("order_id", "customer_id", F.lit(k == -1).alias("now")) for k in (-2, -1))
        lines = items.of_two_versions(i[-2]["version"], i[-1]["version"], i).select("order_id", "quantity", "price", "_side")
        return by_customer(signed_contributions(before.unionByName(after), lines.join(ids, "order_id", "left_semi")))

    def refresh(self, orders: SnapshotTable, items: SnapshotTable, customers: SnapshotTable, order_changes: DataFrame, item_changes: DataFrame,
                customer_changes: DataFrame, ts: str) -> None:
        """Take in the last merge of each of the three tables."""
        ids = self.changed_orders(items, order_changes, item_changes)
        delta = self.wh.save(self.delta(ids, orders, items), "gold", f"{self.name}_delta")
        touched = delta.select("customer_id").unionByName(customer_changes.select("customer_id")).filter(F.col("customer_id").isNotNull()).distinct()
        touched = self.wh.save(touched, "gold", f"{self.name}_touched")
        log = self.customers.log()
        old = self.customers.current_of_keys(touched, log)
        old = old.select("customer_id", *[F.col(c).alias(f"old_{c}") for c in ("state", "known", *MEASURES, "since")])
        dim = customers.current_of_keys(touched).select("customer_id", "state", F.lit(True).alias("known"))
        zero = F.lit(0)
        rows = touched.join(old, "customer_id", "left").join(delta, "customer_id", "left").join(dim, "customer_id", "left").select(
            "customer_id", *[c for c in old.columns if c != "customer_id"], "state", F.coalesce("known", F.lit(False)).alias("known"),
            *[(F.coalesce(f"old_{m}", zero) + F.coalesce(m, zero)).cast("decimal(38,2)" if m == "revenue" else "long").alias(m) for m in MEASURES],
            F.coalesce("old_since", ntz(ts)).alias("since"))
        # a customer that never had an order has no row
        rows = self.wh.save(rows.filter(F.col("old_since").isNotNull() | (F.col("orders") > 0)), "gold", f"{self.name}_customer_changes")
        moved = state_sums(rows.filter(F.col("old_since").isNotNull()), "old_", -1).unionByName(state_sums(rows, "", 1))
        totals = state_totals(self.totals.current().unionByName(moved))
        self.customers.commit_changes(rows.select("customer_id", "state", "known", *MEASURES, "since"), ts, F.col("since") == ntz(ts), log)
        self.totals.commit(totals, ts, "UPDATE")

    def mart(self) -> DataFrame:
        return state_mart(self.totals.current())


# -- distinct counts that can be merged ------------------------------------------------------

PER_BITMAP = 1 << 15


def _bitmap_parts(key: str) -> list[Column]:
    return [F.shiftright(F.col(key), 15).alias("bucket"), F.col(key).bitwiseAND(F.lit(PER_BITMAP - 1)).alias("bit")]


def daily_bitmaps(totals: DataFrame) -> DataFrame:
    """(sales_date, what, bucket, bits): the exact sets of a day's orders and customers.

    A set is cut into ranges of 32,768 ids, each a bitmap of 4 KB (``PER_BITMAP``), so a day
    is as many rows as it has ranges and a hot day is no single buffer. Null ids are in no set.
    """
    out = None
    for what, key in (("orders", "order_id"), ("customers", "customer_id")):
        bits = totals.filter(F.col(key).isNotNull()).select("sales_date", F.lit(what).alias("what"), *_bitmap_parts(key))
        out = bits if out is None else out.unionByName(bits)
    return out.groupBy("sales_date", "what", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def daily_sums(totals: DataFrame) -> DataFrame:
    return totals.groupBy("sales_date").agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"))


def monthly_from_daily(sums: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The monthly mart out of the days': sums add up, sets are joined bit by bit.

    No distinct aggregate is planned, so no row is expanded; months, quarters or any other
    group of days can be had from the same two small tables.
    """
    month = [F.year("sales_date").alias("year"), F.month("sales_date").alias("month"), month_start("sales_date").alias("month_start")]
    united = bitmaps.groupBy(*month, "what", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    distinct = united.groupBy("year", "month", "month_start").agg(*[
        F.coalesce(F.sum(F.when(F.col("what") == what, F.bitmap_count("bits"))), F.lit(0)).cast("long").alias(f"monthly_{what}") for what in ("orders", "customers")])
    added = sums.groupBy(*month).agg(as_double(F.sum("revenue")).alias("monthly_revenue"), ratio(F.sum("revenue"), F.sum("lines")).alias("avg_line_value"),
                                     F.sum("quantity").alias("monthly_quantity_sold"))
    same = [distinct[c].eqNullSafe(added[c]) for c in ("year", "month", "month_start")]
    return added.join(distinct, same[0] & same[1] & same[2], "left").select(
        added["year"], added["month"], added["month_start"], F.coalesce("monthly_orders", F.lit(0).cast("long")).alias("monthly_orders"),
        F.coalesce("monthly_customers", F.lit(0).cast("long")).alias("monthly_customers"), "monthly_revenue", "avg_line_value", "monthly_quantity_sold")
