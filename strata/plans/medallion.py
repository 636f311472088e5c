"""End-to-end medallion runs over the given tables.

``MedallionRun`` materializes each table once (as catalog tables under the
shared folder) and hands later layers fresh scans, so every stage's lineage
starts at files: a lost executor never replays the layers above it. A stage called by
itself builds its whole layer; a table asked for by name builds the tables it is made of
and no others, so a query on orders does not land, load and write the order lines.

Two runs are modelled:
* full run     - raw extracts -> bronze -> typed silver (full load at ``run_ts``) -> gold
* incremental  - silver loaded from the extract as of ``initial_ts``, then merged
                 with the rows changed since the mark at ``incremental_ts``
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import Config
from strata.operators import gold, increments, layout, reconcile, schema, silver
from strata.operators.clustering import ClusteredTable
from strata.operators.increments import StateRevenue
from strata.operators.skipping import FileIndex
from strata.operators.snapshots import SnapshotTable
from strata.sources import bronze, retail
from strata.sources.tables import Warehouse

# Fixed values of the snapshot scenario: (last sales_date included or None for all,
# commit timestamp, operation); retention is evaluated at SNAPSHOT_NOW.
SNAPSHOT_PLAN = [
    ("1998-12-31", "2024-01-01 00:00:00", "CREATE TABLE AS SELECT"),
    ("1999-12-31", "2024-01-10 00:00:00", "WRITE"),
    (None, "2024-01-20 00:00:00", "WRITE"),
]
SNAPSHOT_NOW = "2024-01-25 00:00:00"
# the first of two increments (fixed value of that scenario)
MIDDLE_TS = "2000-01-01 00:00:00"
# Fixed values of the merged products: (created after, created by, commit timestamp, operation)
MERGED_PLAN = [
    ("1900-01-01", "1996-12-31", "2023-12-01 00:00:00", "WRITE"),
    ("1996-12-31", "1997-12-31", "2023-12-10 00:00:00", "MERGE"),
    ("1900-01-01", "1900-01-01", "2024-01-02 00:00:00", "COMPACT"),
    ("1997-12-31", "1998-12-31", "2024-01-05 00:00:00", "MERGE"),
    ("1996-12-31", "1999-12-31", "2024-01-20 00:00:00", "MERGE"),
    ("1900-01-01", "1900-01-01", "2024-01-24 00:00:00", "COMPACT"),
]
# Fixed values of the reconciliation: orders changed late, gone from the source, lost in the target
LATE, GONE, LOST = 97, 101, 103
# Tables of the layers beside the entities, and what each is made of
SILVER_PARTS = {"table_logger": retail.ENTITIES, "orders_with_customers": ("orders", "customers"),
                "orders_with_products": ("orders", "order_items", "products")}
GOLD_PARTS = {"dim_customers": (), "dim_products": (), "fact_sales": (), "order_totals": ("fact_sales",),
              "agg_revenue_by_state": ("order_totals", "dim_customers"), "agg_top_products": ("fact_sales", "dim_products"),
              "agg_daily_sales": ("order_totals",), "agg_monthly_sales": ("order_totals",)}
STAR_PARTS = {"dim_customers": ("customers",), "dim_products": ("products",), "fact_sales": ("orders", "order_items")}
# A file of a sorted table is sorted by one task, in which its rows take some ten times their
# bytes: the files of the z-ordered and the clustered fact are this part of ``target_file_bytes``
SORTED_PART = 8
ZORDER_COLS = ["customer_id", "product_id", "sales_date"]


def concurrently(tasks: dict[str, Callable[[], object]], workers: int) -> dict[str, object]:
    """Run independent Spark jobs from driver threads; results by name, first error re-raised."""
    with ThreadPoolExecutor(max(1, workers)) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def with_parts(names: tuple[str, ...], parts: dict[str, tuple[str, ...]]) -> list[str]:
    """``names`` and all they are made of, parts first, each once."""
    out: list[str] = []
    for n in names:
        out += [x for x in [*with_parts(parts.get(n, ()), parts), n] if x not in out]
    return list(dict.fromkeys(out))


def _stage(fn):
    """Build a stage under the run lock (one builder at a time per run).

    Accessors used inside the stages' worker threads (``raw``, ``silver_table``)
    only enter a stage when it is not built yet, so workers never wait on the lock.
    """
    @functools.wraps(fn)
    def run(self, *args, **kwargs):
        with self._lock:
            return fn(self, *args, **kwargs)
    return run


class MedallionRun:
    def __init__(self, spark: SparkSession, sf_dir: str, config: Config | None = None,
                 warehouse: Warehouse | None = None, config_file: str | None = None):
        """``config_file``: the user's own ingestion config; without one the run lands
        extracts of the given tables and a config for them."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.config = (config or Config()).resolved()
        self.wh = warehouse or Warehouse(spark, self.config)
        self._bronze: dict[str, str] = {}
        # names of the tables built so far, and entities merged
        self._silver: set[str] = set()
        self._gold: set[str] = set()
        self._incremental: set[str] = set()
        self.config_file = config_file
        self._buckets: int | None = None
        self._built: set[str] = set()
        self._lock = threading.RLock()

    def _fresh(self, table: str) -> bool:
        """True once a table and run: a rerun writes its tables again, whatever an earlier run left."""
        if table in self._built:
            return False
        self._built.add(table)
        return True

    # -- bronze ------------------------------------------------------------
    @_stage
    def land(self, entities: tuple[str, ...] = retail.ENTITIES) -> str:
        """Drop the raw text extracts + the JSON config (stands in for the upstream files)."""
        if self.config_file is not None:
            return self.config_file
        extracts = {e: retail.as_raw(retail.entity(self.spark, self.sf_dir, e)) for e in entities}
        name = "metadata_config" if len(entities) == len(retail.ENTITIES) else "_".join(("metadata_config", *entities))
        return bronze.land_raw(self.wh, extracts, self.config.parallel_jobs, f"{name}.json")

    @_stage
    def bronze(self, entities: tuple[str, ...] = retail.ENTITIES) -> dict[str, str]:
        """Bronze tables by name: all that a user's config names, else those of ``entities``."""
        if self.config_file is not None:
            missing = () if self._bronze else entities
        else:
            missing = tuple(e for e in entities if f"raw_{e}" not in self._bronze)
        if missing:
            self._bronze |= bronze.ingest(self.wh, self.land(missing), self.config.run_ts, self.config.parallel_jobs)
        return dict(self._bronze)

    def raw(self, entity: str) -> DataFrame:
        if f"raw_{entity}" not in self._bronze:
            self.bronze((entity,))
        return self.wh.table("bronze", f"raw_{entity}")

    # -- silver ------------------------------------------------------------
    @_stage
    def silver(self, tables: tuple[str, ...] = (*retail.ENTITIES, *SILVER_PARTS)) -> None:
        """Typed full loads of the entities, the control table and the joined tables."""
        needed = [t for t in with_parts(tables, SILVER_PARTS) if t not in self._silver]
        entities = tuple(e for e in retail.ENTITIES if e in needed)
        if entities:
            self.bronze(entities)
            bucketed = {e: self._bucket(e) for e in entities if e != "order_items"}
            # the lines are read by order, never by their own key: as they come, without a shuffle
            concurrently({
                e: (lambda e=e: self.wh.save(silver.full_load(self.raw(e), e, self.config.run_ts), "silver", e,
                                             bucket_by=bucketed.get(e)))
                for e in entities}, self.config.parallel_jobs)
            self._silver |= set(entities)
        s = self.silver_table
        build = {
            "table_logger": lambda: silver.logger_init({e: s(e) for e in retail.ENTITIES}),
            "orders_with_customers": lambda: silver.orders_with_customers(s("orders"), s("customers")),
            "orders_with_products": lambda: silver.orders_with_products(s("orders"), s("order_items"), s("products")),
        }
        rest = [t for t in needed if t in build]
        concurrently({t: (lambda t=t: self.wh.save(build[t](), "silver", t)) for t in rest}, self.config.parallel_jobs)
        self._silver |= set(rest)

    def buckets(self) -> int:
        if self._buckets is None:
            if self.config_file is not None:
                by_size = layout.tasks_for(self.raw("order_items"), self.config.target_file_bytes)
            else:  # as text the lines take about twice their source table's bytes
                lines = retail.read_table(self.spark, self.sf_dir, "lineitem")
                by_size = layout.tasks_for(lines, self.config.target_file_bytes // 2)
            self._buckets = self.config.buckets or max(by_size, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self._buckets

    def _bucket(self, entity: str) -> tuple[int, str]:
        return self.buckets(), silver.KEYS[entity]

    def silver_table(self, entity: str) -> DataFrame:
        if entity not in self._silver:
            self.silver((entity,))
        return self.wh.table("silver", entity)

    # -- gold --------------------------------------------------------------
    @_stage
    def gold(self, tables: tuple[str, ...] = tuple(GOLD_PARTS)) -> None:
        """The star (two dimensions and the fact) and the marts."""
        needed = [t for t in with_parts(tables, GOLD_PARTS) if t not in self._gold]
        if not needed:
            return
        s, g = self.silver_table, self.gold_table
        self.silver(tuple(dict.fromkeys(e for t in needed for e in STAR_PARTS.get(t, ()))))
        n = self.buckets()
        keys = {"dim_customers": (n, "customer_id"), "dim_products": (n, "product_id")}
        build = {
            "dim_customers": lambda: gold.dim_customers(s("customers")),
            "dim_products": lambda: gold.dim_products(s("products")),
            "fact_sales": lambda: gold.fact_sales(s("orders"), s("order_items")),
            # three marts need the fact by order only: it is reduced to that once
            "order_totals": lambda: gold.order_totals(g("fact_sales")),
            "agg_revenue_by_state": lambda: gold.state_revenue(g("order_totals"), g("dim_customers")),
            "agg_top_products": lambda: gold.top_products(g("fact_sales"), g("dim_products")),
            "agg_daily_sales": lambda: gold.by_day(g("order_totals")),
            "agg_monthly_sales": lambda: gold.by_month(g("order_totals")),
        }
        for step in (STAR_PARTS, ("order_totals",), [t for t in GOLD_PARTS if t.startswith("agg_")]):
            now = [t for t in needed if t in step]
            concurrently({t: (lambda t=t: self.wh.save(build[t](), "gold", t, bucket_by=keys.get(t))) for t in now},
                         self.config.parallel_jobs)
            self._gold |= set(now)

    def gold_table(self, name: str) -> DataFrame:
        if name not in self._gold:
            self.gold((name,))
        return self.wh.table("gold", name)

    def fact(self) -> DataFrame:
        return self.gold_table("fact_sales")

    # -- layout ------------------------------------------------------------
    @_stage
    def partitioned_fact(self) -> DataFrame:
        """The fact as a table partitioned by year / month of the sales date."""
        if self._fresh("fact_sales_partitioned"):
            layout.write_partitioned(self.wh, self.fact(), "gold", "fact_sales_partitioned", "sales_date")
        return self.wh.table("gold", "fact_sales_partitioned")

    def sorted_bytes(self) -> int:
        """Bytes of a file that one task sorts."""
        return max(1, self.config.target_file_bytes // SORTED_PART)

    @_stage
    def zordered_fact(self) -> DataFrame:
        """The fact rewritten into files of ``sorted_bytes`` clustered on three columns."""
        if self._fresh("fact_sales_zordered"):
            files = layout.tasks_for(self.fact(), self.sorted_bytes())
            self.wh.save(layout.zorder_cluster(self.fact(), ZORDER_COLS, files), "gold", "fact_sales_zordered")
        return self.wh.table("gold", "fact_sales_zordered")

    # -- snapshots ---------------------------------------------------------
    @_stage
    def fact_snapshots(self, name: str = "fact_sales_versions") -> SnapshotTable:
        """Three committed versions of the fact (growing by sales date)."""
        st = SnapshotTable(self.wh, "gold", name)
        if self._fresh(name):
            st.drop()
            fact = self.fact()
            for last_day, ts, op in SNAPSHOT_PLAN:
                part = fact if last_day is None else fact.filter(fact.sales_date <= last_day)
                st.commit(part, ts, op)
        return st

    @_stage
    def retained_snapshots(self) -> SnapshotTable:
        """Versions of the product table with retention applied (the fact's stay whole)."""
        st = SnapshotTable(self.wh, "gold", "dim_products_retained")
        if self._fresh("dim_products_retained"):
            st.drop()
            products = self.gold_table("dim_products")
            for last_day, ts, op in SNAPSHOT_PLAN:
                st.commit(products if last_day is None else products.filter(products.created_at <= last_day), ts, op)
            st.vacuum(self.config.retention_hours, SNAPSHOT_NOW)
        return st

    @_stage
    def retained_merges(self) -> SnapshotTable:
        """Two chains of merges into the products, and retention while the second is still read."""
        st = SnapshotTable(self.wh, "gold", "products_merged", bucket_by=(self.buckets(), "product_id"))
        if self._fresh("products_merged"):
            st.drop()
            products = self.silver_table("products").drop(*silver.AUDIT)
            for first_day, last_day, ts, op in MERGED_PLAN:
                part = products.filter((products.created_at > first_day) & (products.created_at <= last_day))
                if op == "MERGE":
                    silver.merge_into(st, part, "product_id", ts)
                elif op == "COMPACT":
                    st.compact(ts)
                else:
                    st.commit(silver.stamp_load(part, ts), ts, op)
            st.vacuum(self.config.retention_hours, SNAPSHOT_NOW)
        return st

    # -- damaged extracts ----------------------------------------------------------
    @_stage
    def guarded_orders(self) -> tuple[DataFrame, DataFrame]:
        """Orders out of an extract with broken lines: the table and its quarantine."""
        if self._fresh("raw_orders_guarded"):
            orders = retail.entity(self.spark, self.sf_dir, "orders")
            path = f"{self.wh.root}/raw_data/orders_damaged.csv"
            retail.damaged_lines(orders, "order_id").write.mode("overwrite").text(path)
            bronze.load_guarded(self.wh, path, "raw_orders_guarded", orders.columns, self.config.run_ts, header=False)
        return self.wh.table("bronze", "raw_orders_guarded"), self.wh.table("bronze", "raw_orders_guarded_quarantine")

    # -- what the mark misses ------------------------------------------------------
    @_stage
    def reconciled_orders(self) -> DataFrame:
        """Orders of the extract against a silver table with planted gaps: some orders are
        missing on either side, and some were changed without a new stamp."""
        if self._fresh("reconciled_orders"):
            orders = self.silver_table("orders").drop(*silver.AUDIT)
            late = F.when(F.col("order_id") % LATE == 0, F.lit("late")).otherwise(F.col("order_status"))
            source = orders.filter(F.col("order_id") % GONE != 0).withColumn("order_status", late)
            target = self.wh.save(orders.filter(F.col("order_id") % LOST != 0), "silver", "orders_reconciled")
            found = reconcile.reconcile(self.wh, source, target, "order_id", orders.columns, "orders", levels=2, leaf_bits=6)
            self.wh.save(found, "silver", "orders_findings")
        return self.wh.table("silver", "orders_findings")

    # -- clustering by increments ---------------------------------------------------
    @_stage
    def clustered_sales(self) -> ClusteredTable:
        """The fact clustered on its customers: half of it, then six runs, then a join of the small ones."""
        table = ClusteredTable(self.wh, "gold", "fact_sales_clustered", "customer_id", self.sorted_bytes())
        if self._fresh("fact_sales_clustered"):
            table.drop()
            fact = self.fact()
            files = max(8, layout.tasks_for(fact, self.sorted_bytes()))
            table.append(fact.filter(F.col("sales_id") % 100 < 94), files)
            for k in range(94, 100):
                table.append(fact.filter(F.col("sales_id") % 100 == k), -(-files // 100))
                table.recluster()
        return table

    # -- marts kept up to date ----------------------------------------------------
    @_stage
    def state_revenue(self) -> StateRevenue:
        """Revenue by state after a first load and two increments of three entities."""
        st = StateRevenue(self.wh, "state_revenue", self.buckets())
        if self._fresh("state_revenue"):
            tag, entities = "_mart", ("orders", "order_items", "customers")
            tables = {e: self.silver_versions(e, tag) for e in entities}
            for t in (self.control(tag), *tables.values(), st):
                t.drop()
            for ts, extract in ((MIDDLE_TS, MIDDLE_TS), (self.config.incremental_ts, None)):
                first = self.control(tag).latest_version() is None
                self.increment(ts, entities, tag, extract_ts=extract)
                if first:
                    st.build(*(t.as_of_version(0) for t in tables.values()), self.config.initial_ts)
                changes = [self.wh.table("silver", f"{e}_changes{tag}") for e in entities]
                st.refresh(*tables.values(), *changes, ts)
        return st

    @_stage
    def daily_sets(self) -> tuple[DataFrame, DataFrame]:
        """The days' sums and the exact sets of their orders and customers."""
        if self._fresh("daily_sets"):
            totals = self.gold_table("order_totals")
            self.wh.save(increments.daily_sums(totals), "gold", "daily_sums")
            self.wh.save(increments.daily_bitmaps(totals), "gold", "daily_bitmaps")
        return self.wh.table("gold", "daily_sums"), self.wh.table("gold", "daily_bitmaps")

    # -- files that a read can skip ---------------------------------------------
    @_stage
    def indexed_orders(self) -> SnapshotTable:
        """The orders with a file index on their key, loaded and merged like the others."""
        st = SnapshotTable(self.wh, "silver", "orders_indexed", bucket_by=self._bucket("orders"), index=["order_id"])
        if self._fresh("orders_indexed"):
            self.incremental(("orders",))
            st.drop()
            first = self.silver_versions("orders").as_of_version(0)
            st.commit(first, self.config.initial_ts)
            silver.merge_into(st, self.wh.table("silver", "orders_changes"), "order_id", self.config.incremental_ts)
        return st

    @_stage
    def zorder_index(self) -> FileIndex:
        """The file index of the z-ordered fact."""
        self.zordered_fact()
        index = FileIndex(self.wh, "gold", "fact_sales_zordered", ["customer_id", "product_id"])
        if self._fresh("fact_sales_zordered_index"):
            index.drop()
            index.add()
        return index

    # -- schema enforcement ------------------------------------------------
    @_stage
    def products_with_append(self) -> DataFrame:
        """Copy of dim_products plus the changed products appended with 4 of 8 columns."""
        if self._fresh("dim_products_appended"):
            self.wh.save(self.gold_table("dim_products"), "gold", "dim_products_appended")
            changes = self.changes_of("products").select(
                "product_id", "product_name", "category", "price")
            schema.guarded_append(self.spark, self.wh.name("gold", "dim_products_appended"), changes)
        return self.wh.table("gold", "dim_products_appended")

    # -- incremental -------------------------------------------------------
    def control(self, tag: str = "") -> SnapshotTable:
        """The control table of the incremental loads: a mark per entity, a version per run."""
        return SnapshotTable(self.wh, "silver", f"table_logger_versions{tag}")

    def silver_versions(self, entity: str, tag: str = "") -> SnapshotTable:
        """The versioned silver table of one entity (a load, then a version per merge)."""
        return SnapshotTable(self.wh, "silver", f"{entity}_versions{tag}", bucket_by=self._bucket(entity),
                             key=silver.KEYS[entity])

    @_stage
    def increment(self, ts: str, entities: tuple[str, ...] = tuple(retail.ENTITIES), tag: str = "",
                  extract_ts: str | None = None) -> None:
        """One incremental run at ``ts`` over ``entities``.

        It goes on from what earlier runs left: the mark is read from the control table,
        the rows changed since are merged into the current version, and the marks of the
        entities merged are set to ``ts``. Only an entity without a version is loaded in
        full first, from the extract as of ``initial_ts``; an entity that the control table
        does not know yet is added to it. ``extract_ts``: the extract as
        it looked then (None: all of it). The mark is the stamp of a run's begin, so rows
        that change during it are not skipped.
        """
        c = self.config
        self.bronze(entities)
        self.buckets()  # before the worker threads ask for them
        control = self.control(tag)

        def extract(e: str, at: str | None) -> DataFrame:
            full = silver.typed(self.raw(e), silver.SPECS[e])
            return full if at is None else retail.as_of(full, at, silver.KEYS[e])

        def first_load(e: str) -> DataFrame:
            st = self.silver_versions(e, tag)
            if st.latest_version() is None:
                st.commit(silver.stamp_load(extract(e, c.initial_ts), c.initial_ts), c.initial_ts, "WRITE")
            return st.current()

        known = control.latest_version() is not None
        marked = {r["table_name"] for r in control.current().select("table_name").collect()} if known else set()
        new = [e for e in entities if e not in marked]
        if new:
            loaded = silver.logger_init(concurrently({e: (lambda e=e: first_load(e)) for e in new}, c.parallel_jobs))
            control.commit(control.current().unionByName(loaded) if known else loaded, c.initial_ts, "WRITE")
        logger = control.current()

        def merge(e: str) -> int:
            mark = silver.read_mark(logger, e)
            src = self.wh.save(silver.changed_since(extract(e, extract_ts), mark), "silver", f"{e}_changes{tag}")
            # new version = upsert of the current one; the bucketed current version is read by
            # bucket and the merged rows are written from the join tasks (only the source moves)
            return silver.merge_into(self.silver_versions(e, tag), src, silver.KEYS[e], ts)

        concurrently({e: (lambda e=e: merge(e)) for e in entities}, c.parallel_jobs)
        for e in entities:
            logger = silver.logger_update(logger, e, ts)
        control.commit(logger, ts, "UPDATE")

    @_stage
    def incremental(self, entities: tuple[str, ...] = tuple(retail.ENTITIES)) -> None:
        """The increment of ``entities`` at ``incremental_ts``, once a run (after a first load where there is none)."""
        missing = tuple(e for e in entities if e not in self._incremental)
        if missing:
            self.increment(self.config.incremental_ts, missing)
            self._incremental |= set(missing)

    @_stage
    def two_increments(self) -> None:
        """Orders and customers, loaded, merged from the extract as of ``MIDDLE_TS``, and the
        orders merged once more later: the second run goes on from the first one's marks."""
        if self._fresh("two_increments"):
            for st in (self.control("_two"), *(self.silver_versions(e, "_two") for e in ("orders", "customers"))):
                st.drop()
            self.increment(MIDDLE_TS, ("orders", "customers"), "_two", extract_ts=MIDDLE_TS)
            self.increment(self.config.incremental_ts, ("orders",), "_two")

    def merged(self, entity: str) -> DataFrame:
        """Current (merged) version of an entity after the incremental run."""
        if entity not in self._incremental:
            self.incremental((entity,))
        return self.silver_versions(entity).current()

    def changes_of(self, entity: str) -> DataFrame:
        """The rows of an entity that the incremental run merged."""
        if entity not in self._incremental:
            self.incremental((entity,))
        return self.wh.table("silver", f"{entity}_changes")


_CACHE: dict[tuple, MedallionRun] = {}
_CACHE_LOCK = threading.Lock()


def run_for(spark: SparkSession, sf_dir: str, config: Config | None = None) -> MedallionRun:
    """One run per (session, data folder) so several queries share the written layers."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), config)
    with _CACHE_LOCK:
        p = _CACHE.get(key)
        if p is None:
            p = _CACHE[key] = MedallionRun(spark, sf_dir, config)
        return p
