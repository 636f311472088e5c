"""Silver layer: typed loads, the high-water-mark control table, key checks,
reject reports, the incremental source and the key-based upsert (MERGE)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expressions import ntz, null_ts

# Typed schema of each silver entity (column, Spark type) and its key.
# Money is decimal instead of the reference's float (exact sums); ids are bigint
# instead of the reference's int, which runs out at ~2.1 billion rows (far below
# the order and line counts of a 100 TB run).
SPECS: dict[str, list[tuple[str, str]]] = {
    "customers": [
        ("customer_id", "bigint"), ("name", "string"), ("city", "string"), ("state", "string"),
        ("signup_date", "date"), ("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz"),
    ],
    "order_items": [
        ("order_item_id", "bigint"), ("order_id", "bigint"), ("product_id", "bigint"), ("quantity", "int"),
        ("price", "decimal(12,2)"), ("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz"),
    ],
    "orders": [
        ("order_id", "bigint"), ("customer_id", "bigint"), ("order_date", "date"),
        ("total_amount", "decimal(14,2)"), ("order_status", "string"),
        ("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz"),
    ],
    "products": [
        ("product_id", "bigint"), ("product_name", "string"), ("category", "string"),
        ("price", "decimal(12,2)"), ("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz"),
    ],
}
KEYS = {"customers": "customer_id", "order_items": "order_item_id", "orders": "order_id", "products": "product_id"}
AUDIT = ("record_created_at", "record_updated_at")


def typed(raw: DataFrame, spec: list[tuple[str, str]], strict: bool = True) -> DataFrame:
    """Project raw text columns to their types.

    ``strict`` casts fail the job on a bad value (ANSI); the reject report uses ``try_cast``.
    """
    return raw.select([
        (F.col(c).cast(t) if strict or t == "string" else F.col(c).try_cast(t)).alias(c) for c, t in spec
    ])


def stamp_load(df: DataFrame, run_ts: str) -> DataFrame:
    """``record_created_at`` = load stamp, ``record_updated_at`` NULL (the insert omits it)."""
    return df.select("*", ntz(run_ts).alias("record_created_at"), null_ts().alias("record_updated_at"))


def full_load(raw: DataFrame, entity: str, run_ts: str) -> DataFrame:
    """Typed full load of one entity from its bronze table."""
    return stamp_load(typed(raw, SPECS[entity]), run_ts)


# -- control table -------------------------------------------------------------

def logger_init(loaded: dict[str, DataFrame]) -> DataFrame:
    """(table_name, last_run_time) with the mark = max(record_created_at) per loaded table."""
    parts = [df.agg(F.max("record_created_at").alias("last_run_time"))
             .select(F.lit(name).alias("table_name"), "last_run_time") for name, df in loaded.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_mark(logger: DataFrame, table_name: str) -> _dt.datetime | None:
    """Scalar lookup of one table's mark (the control table has one row per table)."""
    row = logger.filter(F.col("table_name") == table_name).select("last_run_time").first()
    return None if row is None else row[0]


def logger_update(logger: DataFrame, table_name: str, ts: str) -> DataFrame:
    """``update logger set last_run_time = ts where table_name = name``."""
    return logger.withColumn(
        "last_run_time",
        F.when(F.col("table_name") == table_name, ntz(ts)).otherwise(F.col("last_run_time")))


# -- incremental source ----------------------------------------------------------

def changed_since(df: DataFrame, mark) -> DataFrame:
    """Rows with ``created_at > mark OR updated_at > mark`` (three-valued OR).

    A NULL / missing mark means "never loaded": every row qualifies.
    """
    if mark is None:
        return df
    m = ntz(mark.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(mark, _dt.datetime) else str(mark))
    return df.filter((F.col("created_at") > m) | (F.col("updated_at") > m))


def incremental_source(raw: DataFrame, entity: str, mark) -> DataFrame:
    return changed_since(typed(raw, SPECS[entity]), mark)


# -- merge -------------------------------------------------------------------------

def upsert(target: DataFrame, source: DataFrame, key: str, run_ts: str, check: bool = True) -> DataFrame:
    """``MERGE INTO target USING source ON key`` as one full outer join.

    matched      -> business columns from the source, record_updated_at = run_ts, record_created_at kept
    source only  -> inserted, record_created_at = run_ts, record_updated_at NULL
    target only  -> untouched (no delete clause)
    A NULL source key never matches, so it is inserted (SQL ``=`` semantics).

    ``check``: MERGE fails when several source rows match one target row. The
    guard runs inside the merge job: a count per key over the source (its window
    shuffles the source by key, which is the shuffle the join needs anyway) and an
    error raised for any matched row whose key has more than one source row.
    Unmatched duplicates are all inserted, as MERGE does.
    """
    business = [c for c in target.columns if c not in AUDIT]
    missing = [c for c in business if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    # NULL keys match nothing: they are inserted beside the join, so however many there
    # are they are no window group and no join partition
    unkeyed = source.filter(F.col(key).isNull()).select(
        *business, ntz(run_ts).alias("record_created_at"), null_ts().alias("record_updated_at"))
    s = source.filter(F.col(key).isNotNull()).select(
        *[F.col(c).alias(f"s_{c}") for c in business], F.lit(True).alias("_in_s"))
    if check:
        s = s.withColumn("_n_src", F.count(F.lit(1)).over(Window.partitionBy(f"s_{key}")))
    j = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    in_t = F.col("_in_t").isNotNull()
    in_s = F.col("_in_s").isNotNull()
    if check:  # a row filter: no column pruning above can take it away
        j = j.filter(F.when(in_t & in_s & (F.col("_n_src") > 1), F.raise_error(F.concat(
            F.lit(f"MERGE conflict: several source rows match target {key}="),
            F.col(f"t_{key}").cast("string"))).cast("boolean")).otherwise(F.lit(True)))
    matched = F.when(in_t & in_s, ntz(run_ts))
    cols: list[Column] = [F.when(in_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in business]
    cols.append(F.when(in_t, F.col("t_record_created_at")).otherwise(ntz(run_ts)).alias("record_created_at"))
    cols.append(matched.when(in_t, F.col("t_record_updated_at")).otherwise(null_ts()).alias("record_updated_at"))
    return j.select(cols).unionByName(unkeyed.select([c.name for c in target.schema.fields if c.name in (*business, *AUDIT)]))


# -- checks ------------------------------------------------------------------------

def key_check(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Keys that a primary-key constraint would reject: NULL or repeated (with their row count)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter((F.col("row_count") > 1) | any_null))


def _bad(c: str, t: str) -> Column:
    return F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()


def reject_rows(raw: DataFrame, entity: str) -> DataFrame:
    """Raw rows a strict load would fail on, with the offending column names."""
    checks = [(c, t) for c, t in SPECS[entity] if t != "string"]
    flags = F.array_compact(F.array(*[F.when(_bad(c, t), F.lit(c)) for c, t in checks]))
    return raw.withColumn("rejected_columns", flags).filter(F.size("rejected_columns") > 0)


def reject_summary(raw: DataFrame, entity: str) -> DataFrame:
    """(table_name, column_name, rows_checked, rejected) for every typed column, one pass."""
    checks = [(c, t) for c, t in SPECS[entity] if t != "string"]
    agg = raw.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count(F.when(_bad(c, t), 1)).alias(c) for c, t in checks],
    )
    return agg.unpivot("rows_checked", [c for c, _ in checks], "column_name", "rejected").select(
        F.lit(entity).alias("table_name"), "column_name", "rows_checked", "rejected")


# -- silver joins -----------------------------------------------------------------

def orders_with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id").select(
        "order_id", "order_date", "total_amount", "order_status", "customer_id",
        F.col("name").alias("customer_name"), "city", "state", "signup_date")


def orders_with_products(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    o = orders.select("order_id", "order_date", "order_status", "customer_id")
    i = items.select("order_id", "order_item_id", "product_id", "quantity", F.col("price").alias("item_price"))
    p = products.select("product_id", "product_name", "category")
    return o.join(i, "order_id").join(p, "product_id").select(
        "order_id", "order_date", "order_status", "customer_id", "order_item_id", "product_id",
        "product_name", "category", "quantity", "item_price",
        (F.col("quantity") * F.col("item_price")).alias("line_total"))


def merge_into(table, source: DataFrame, key: str, run_ts: str) -> int:
    """``MERGE INTO`` a versioned table; returns the new version (operation ``MERGE``).

    ``table`` is a :class:`strata.operators.snapshots.SnapshotTable`. If ``key`` is the
    table's key, only the current rows whose key is in the source take part, and only they
    and the inserted rows are written, so a merge writes as much as changes; a table bucketed
    on ``key`` is read by bucket and only the source is shuffled, and with the key in its
    file index only the files that can hold a key of the source are read. A table with another key or
    none gets the whole merged table as a full version.
    """
    log = table.log()
    if table.key != key:
        return table.commit(upsert(table.current(log), source, key, run_ts), run_ts, "MERGE" if not table.key else "WRITE", log=log)
    keys = source.filter(F.col(key).isNotNull()).select(key).distinct()
    touched = table.current_of_keys(keys, log)
    merged = upsert(touched, source, key, run_ts)
    # every touched row is matched, so a row without an update stamp is a new one
    return table.commit_changes(merged, run_ts, F.col("record_updated_at").isNull(), log)
