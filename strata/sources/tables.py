"""Layered tables in the session catalog, stored as Parquet under the shared folder.

Each layer (bronze / silver / gold) is a catalog schema whose LOCATION is a
folder of the run root, so managed tables never land in a machine-local
``spark-warehouse``. Written tables also cut lineage: downstream jobs read
files, not the plan that produced them, so a lost executor only costs the
tasks of the current stage.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.config import Config
from strata.session import new_run_root


def _plain(path: str) -> str:
    """A path without the local scheme and trailing slash, for comparison."""
    return re.sub(r"^file:/*", "/", path).rstrip("/")


#: of all tables: smaller than Parquet's default by a quarter or more, for little time
COMPRESSION = "zstd"


class Warehouse:
    """Catalog schemas + table writes for one run.

    ``prefix`` isolates runs that share a session (each gets its own schemas);
    a production job uses the plain layer names.
    """

    def __init__(self, spark: SparkSession, config: Config | None = None, root: str | None = None,
                 prefix: str | None = None):
        self.spark = spark
        self.config = config or Config()
        self.root = (root or new_run_root(spark)).rstrip("/")
        self.prefix = prefix if prefix is not None else f"s{uuid.uuid4().hex[:8]}_"
        self._schemas: set[str] = set()

    # -- names -------------------------------------------------------------
    def schema(self, layer: str) -> str:
        """Catalog schema of a layer: the configured name (bronze / silver / gold) plus the run prefix."""
        names = {"bronze": self.config.bronze_schema, "silver": self.config.silver_schema,
                 "gold": self.config.gold_schema}
        return f"{self.prefix}{names.get(layer, layer)}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # -- DDL ---------------------------------------------------------------
    def ensure_schema(self, layer: str) -> str:
        """``CREATE SCHEMA IF NOT EXISTS`` with a location in the run root (one statement per call)."""
        s = self.schema(layer)
        if s not in self._schemas:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {s} LOCATION '{self.root}/{layer}'")
            at = self.spark.catalog.getDatabase(s).locationUri
            if _plain(at) != _plain(f"{self.root}/{layer}"):
                raise ValueError(f"schema {s} is at {at}, not below {self.root}; give the run its root or other schema names")
            self._schemas.add(s)
        return s

    def ensure_layers(self, layers=("bronze", "silver", "gold")) -> None:
        for layer in layers:
            self.ensure_schema(layer)

    def drop(self, layer: str, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")

    # -- data --------------------------------------------------------------
    def save(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite",
             partition_by: list[str] | None = None, bucket_by: tuple[int, str] | None = None,
             prepartitioned: bool = False) -> DataFrame:
        """Write ``df`` as a managed Parquet table and return a fresh scan of it.

        ``overwrite`` = drop + create as select (the catalog has no
        ``CREATE OR REPLACE`` for Parquet tables). ``bucket_by=(n, key)`` hash-
        partitions on the key first (same hash as the bucket id), so each task
        writes one sorted bucket file and later joins / merges on the key read
        it pre-partitioned. ``prepartitioned=True`` skips that shuffle when the
        rows already sit in their buckets (e.g. the output of a join on the key
        against a table with the same buckets): the writer still computes every
        row's bucket, so the table is right either way.
        """
        self.ensure_schema(layer)
        if bucket_by:
            n, key = bucket_by
            if not prepartitioned:
                df = df.repartition(n, key)
        w = df.write.mode(mode).format("parquet").option("compression", COMPRESSION)
        if bucket_by:
            w = w.bucketBy(n, key).sortBy(key)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(self.name(layer, table))
        return self.table(layer, table)

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def bucketing_of(self, layer: str, table: str) -> tuple[int, str] | None:
        """(bucket count, bucket column) of an existing table, from the catalog; None without buckets."""
        if not self.exists(layer, table):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}").filter("col_name IN ('Num Buckets', 'Bucket Columns')").collect()
        found = {r["col_name"]: r["data_type"] for r in rows}
        return (int(found["Num Buckets"]), found["Bucket Columns"].strip("[]`")) if found else None

    def property_of(self, layer: str, table: str, name: str) -> str | None:
        """A property of an existing table, from the catalog; None where it is not set."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").filter(f"key = '{name}'").collect()
        return rows[0]["value"] if rows else None

    def set_property(self, layer: str, table: str, name: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} SET TBLPROPERTIES ('{name}' = '{value}')")

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))
