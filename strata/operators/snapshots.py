"""Versioned snapshot tables: history, read as of a version or a timestamp, retention.

Plain Parquet has no transaction log, so a snapshot table is a catalog table
partitioned by ``_version`` (one folder per committed version) plus a small
``<name>_history`` table (version, timestamp, operation, num_rows). Reading a
version is a partition-pruned scan; expiring a version is
``ALTER TABLE .. DROP PARTITION``, which removes its files. A new version is
written while older ones are read (no overwrite of a table being read). There is no
commit protocol: one writer a table.

A table with a ``key`` can also hold change versions (operation ``MERGE``): only the rows
that were inserted or changed, all rows of a key together. Reading such a version
takes each key's rows of the latest version since the last full one, on the bucketed
key, so a merge writes what changed and not the whole table; ``compact`` commits a full
version when reads have many changes to go through. A full version and the change
versions built on it are one chain, and retention removes chains, not links of them.

The key is a property of the catalog table (set at the first commit), so whoever opens
the table reads its versions the same way. A table without a key holds full versions only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.skipping import FileIndex, only_files
from strata.sources.tables import COMPRESSION, Warehouse

HISTORY_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("num_rows", T.LongType(), False),
])


def _ts(v) -> _dt.datetime:
    if isinstance(v, _dt.datetime):
        return v
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day)
    return _dt.datetime.fromisoformat(str(v))


KEY_PROPERTY, INDEX_PROPERTY = "strata.key", "strata.index"


class VersionNotFound(LookupError):
    pass


class SnapshotTable:
    """``bucket_by=(n, key)`` buckets every version on its key, so a merge reads the
    current version by bucket and shuffles only the incoming rows. ``index``: columns of
    the file index (:mod:`strata.operators.skipping`), kept up by every commit; with
    the key among them, a merge reads only the files that can hold one of its keys."""

    def __init__(self, wh: Warehouse, layer: str, name: str, bucket_by: tuple[int, str] | None = None,
                 key: str | None = None, index: list[str] | None = None):
        self.wh = wh
        self.spark = wh.spark
        self.layer = layer
        self.name = name
        self.data = wh.name(layer, name)
        self.hist = wh.name(layer, f"{name}_history")
        # an existing table keeps its buckets
        self.bucket_by = wh.bucketing_of(layer, name) if wh.exists(layer, name) else bucket_by
        # so it keeps its key; a new one takes the given key, or the one it is bucketed on
        self._new_key = key or (bucket_by[1] if bucket_by else None)
        self._known_key: str | None = None
        self._new_index = list(index or [])

    @property
    def index(self) -> FileIndex | None:
        """The table's file index, if it has one (a property of the catalog table, as the key)."""
        columns = self._new_index
        if self.wh.exists(self.layer, self.name):
            found = self.wh.property_of(self.layer, self.name, INDEX_PROPERTY)
            columns = found.split(",") if found else []
        return FileIndex(self.wh, self.layer, self.name, columns) if columns else None

    @property
    def key(self) -> str | None:
        """The merge key: the catalog's for a table that exists."""
        if self._known_key is None:
            if not self.wh.exists(self.layer, self.name):
                return self._new_key
            self._known_key = self.wh.property_of(self.layer, self.name, KEY_PROPERTY) or ""
        return self._known_key or None

    # -- writes ---------------------------------------------------------------
    def drop(self) -> None:
        """Remove the table with all its versions and its history."""
        self.wh.drop(self.layer, self.name)
        self.wh.drop(self.layer, f"{self.name}_history")
        FileIndex(self.wh, self.layer, self.name, []).drop()
        self._known_key = None

    def commit_changes(self, df: DataFrame, timestamp, inserted: Column, log: list[Row] | None = None) -> int:
        """Write the inserted and changed rows of a merge as the next version.

        ``inserted`` is true for the rows whose key is new; the history's row count is the
        whole table's. A key that is changed has all its rows in ``df``. ``log``: the
        history, if the caller has read it.
        """
        if not self.key:
            raise ValueError(f"{self.data} has no key, so it holds full versions only")
        log = log or self.log()
        return self.commit(df, timestamp, "MERGE", prepartitioned=True, rows=F.count_if(inserted), before=log[-1]["num_rows"], log=log)

    def compact(self, timestamp) -> int:
        """The current rows as a full version; older ones can then expire."""
        return self.commit(self.current(), timestamp, "COMPACT", prepartitioned=True)

    def commit(self, df: DataFrame, timestamp, operation: str = "WRITE", prepartitioned: bool = False,
               rows: Column | None = None, before: int = 0, log: list[Row] | None = None) -> int:
        """Write ``df`` as the next version; record it in the history.

        ``prepartitioned``: the rows already sit in their buckets (a join on the key
        with the bucketed current version), so no shuffle before the write. The row count
        in the history is ``before`` plus ``rows`` (all of them by default).
        """
        self.wh.ensure_schema(self.layer)
        v = self._next_version(log)
        out = df.withColumn("_version", F.lit(v).cast("long"))
        if self.bucket_by and not prepartitioned:
            out = out.repartition(self.bucket_by[0], self.bucket_by[1])
        # the row count rides on the write itself (no second job). It is observed in the
        # write stage, whose tasks report once even when retried, so the count stays exact.
        obs = Observation(f"commit_{self.name}_{v}")
        out = out.observe(obs, (F.count(F.lit(1)) if rows is None else rows).alias("rows"))
        w = out.write.mode("append").format("parquet").option("compression", COMPRESSION).partitionBy("_version")
        if self.bucket_by:
            w = w.bucketBy(self.bucket_by[0], self.bucket_by[1]).sortBy(self.bucket_by[1])
        key = self.key
        w.saveAsTable(self.data)
        if self._known_key is None:  # the table is new
            if self.wh.property_of(self.layer, self.name, KEY_PROPERTY) is None:
                self.wh.set_property(self.layer, self.name, KEY_PROPERTY, key or "")
                self.wh.set_property(self.layer, self.name, INDEX_PROPERTY, ",".join(self._new_index))
            self._known_key = key or ""
        index = self.index
        if index:
            index.add(v)
        n = before + obs.get["rows"]
        row = self.spark.createDataFrame([(v, _ts(timestamp), operation, n)], HISTORY_SCHEMA)
        row.write.mode("append").format("parquet").saveAsTable(self.hist)
        return v

    def _partition_versions(self) -> set[int]:
        """Versions with data folders (catalog metadata, no job)."""
        if not self.spark.catalog.tableExists(self.data):
            return set()
        return {int(r[0].split("=", 1)[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.data}").collect()}

    def log(self) -> list[Row]:
        """The history in order: one small row a commit."""
        if not self.spark.catalog.tableExists(self.hist):
            return []
        return sorted(self.spark.table(self.hist).collect(), key=lambda r: r["version"])

    def _base(self, log: list[Row], v: int) -> int | None:
        """The full version that version ``v`` builds on; None if ``v`` is not in the history."""
        base = None
        for r in log:
            if r["version"] > v:
                break
            if not self.key or r["operation"] != "MERGE":
                base = r["version"]
            found = r["version"]
        return base if base is not None and found == v else None

    def _next_version(self, log: list[Row] | None = None) -> int:
        """One past every version seen in the history *or* on disk: if a run died between
        writing a version's data and its history row, the retry never appends into that folder."""
        seen = self._partition_versions() | {r["version"] for r in (self.log() if log is None else log)}
        return max(seen) + 1 if seen else 0

    # -- metadata -------------------------------------------------------------
    def history(self, limit: int | None = None) -> DataFrame:
        h = self.spark.table(self.hist).orderBy(F.desc("version"))
        return h.limit(limit) if limit else h

    def latest_version(self) -> int | None:
        if not self.spark.catalog.tableExists(self.hist):
            return None
        return self.spark.table(self.hist).agg(F.max("version")).first()[0]

    def versions(self) -> DataFrame:
        """(version, rows written) of the committed versions whose data is still present, counted
        from the files (a folder without a history row, left by a failed run, is not a version)."""
        committed = self.spark.table(self.hist).select("version")
        return (self.spark.table(self.data).groupBy(F.col("_version").alias("version"))
                .agg(F.count(F.lit(1)).alias("num_rows"))
                .join(committed, "version", "left_semi"))

    # -- reads ----------------------------------------------------------------
    def as_of_version(self, v: int, log: list[Row] | None = None) -> DataFrame:
        """Rows of one version. A version that was never committed, or whose data
        retention has removed, is an error (an empty frame would read as 'no rows')."""
        log = log or self.log()
        base = self._base(log, v)
        if not self._there(log, base, self._partition_versions()):
            raise VersionNotFound(f"{self.data} has no version {v} (unknown, or removed by retention)")
        return self.rows_of_chain(self.spark.table(self.data).filter(F.col("_version").between(base, v)), base == v)

    @staticmethod
    def _there(log: list[Row], base: int | None, folders: set[int]) -> bool:
        """Whether a chain's full version can be read: an empty one has no folder."""
        return base is not None and (base in folders or next(r["num_rows"] for r in log if r["version"] == base) == 0)

    def readable(self) -> list[int]:
        """Versions that can be read, those included that changed nothing and so have no folder."""
        log, folders = self.log(), self._partition_versions()
        return [r["version"] for r in log if self._there(log, self._base(log, r["version"]), folders)]

    def rows_of_chain(self, since: DataFrame, full: bool) -> DataFrame:
        """The latest rows of each key out of a chain's (``since`` has ``_version``)."""
        if full:
            return since.drop("_version")
        latest = F.max("_version").over(Window.partitionBy(self.key))
        keyed = since.filter(F.col(self.key).isNotNull()).withColumn("_latest", latest)
        # NULL keys match nothing, so their rows are never replaced
        return keyed.filter("_version = _latest").drop("_version", "_latest").unionByName(
            since.filter(F.col(self.key).isNull()).drop("_version"))

    def current(self, log: list[Row] | None = None) -> DataFrame:
        log = log or self.log()
        if not log:
            raise VersionNotFound(f"{self.data} has no version")
        return self.as_of_version(log[-1]["version"], log)

    def current_of_keys(self, keys: DataFrame, log: list[Row] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the current version (or of ``version``) whose key is in ``keys``.

        With the key in the file index only the files of the chain that can hold one of
        the keys are scanned; the list of files is used while it leaves out at least half.
        """
        log = log or self.log()
        v = log[-1]["version"] if version is None else version
        base = self._base(log, v)
        self.as_of_version(v, log)  # the version must be there
        since = self.spark.table(self.data).filter(F.col("_version").between(base, v))
        index = self.index
        if index and self.key in index.columns and self.bucket_by:
            files = index.files_of_keys(keys, self.key, self.bucket_by[0], (base, v))
            if 2 * len(files) <= index.count((base, v)):
                since = only_files(since, files)
        return self.rows_of_chain(since.join(keys.select(self.key), self.key, "left_semi").select(*since.columns), base == v)

    def current_with(self, values: DataFrame, column: str, log: list[Row] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the current version (or of ``version``) whose ``column`` is in ``values``.

        Another column than the key: what a key has in older versions of the chain may be out
        of date, so the keys that ever had one of the values are looked up. The range of
        the values is pushed down to the scan.
        """
        if column == self.key:
            return self.current_of_keys(values, log, version)
        log = log or self.log()
        v = log[-1]["version"] if version is None else version
        base = self._base(log, v)
        if base == v or not self.key:
            rows = self.as_of_version(v, log)
            return rows.join(values.select(column), column, "left_semi").select(*rows.columns)
        low, high = values.agg(F.min(column), F.max(column)).first()
        since = self.spark.table(self.data).filter(F.col("_version").between(base, v) & F.col(column).between(F.lit(low), F.lit(high)))
        keys = since.join(values.select(column), column, "left_semi").select(self.key).distinct()
        rows = self.current_of_keys(keys, log, v)
        return rows.join(values.select(column), column, "left_semi").select(*rows.columns)

    def of_two_versions(self, old: int, new: int, log: list[Row] | None = None) -> DataFrame:
        """The rows of two versions in one read, with ``_side``: 1 for a row of the older one
        only, 2 for one of the newer one only, 3 for a row that is in both.

        On a chain that both are on nothing is shuffled if the table is bucketed on its key.
        """
        log = log or self.log()
        base = self._base(log, new)
        before, after = self.as_of_version(old, log), self.as_of_version(new, log)  # both must be there
        if old >= new or self._base(log, old) != base:
            return before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(2)))
        since = self.spark.table(self.data).filter(F.col("_version").between(base, new))
        was = F.col("_version") <= old
        keys = Window.partitionBy(self.key)
        keyed = (since.filter(F.col(self.key).isNotNull())
                 .withColumn("_latest", F.max("_version").over(keys)).withColumn("_earlier", F.max(F.when(was, F.col("_version"))).over(keys)))
        side = F.when(F.col("_version").eqNullSafe(F.col("_earlier")), 1).otherwise(0) + F.when(F.col("_version") == F.col("_latest"), 2).otherwise(0)
        # rows with a NULL key are never replaced
        unkeyed = since.filter(F.col(self.key).isNull()).withColumn("_side", F.when(was, 3).otherwise(2))
        return keyed.withColumn("_side", side).filter("_side > 0").drop("_version", "_latest", "_earlier").unionByName(unkeyed.drop("_version"))

    def version_at(self, timestamp) -> int:
        """Latest version committed at or before ``timestamp``; error before the first one."""
        t = _ts(timestamp)
        v = (self.spark.table(self.hist).filter(F.col("timestamp") <= F.lit(t).cast("timestamp_ntz"))
             .agg(F.max("version")).first()[0])
        if v is None:
            raise VersionNotFound(f"{self.data}: no version at or before {t}")
        return v

    def as_of_timestamp(self, timestamp) -> DataFrame:
        return self.as_of_version(self.version_at(timestamp))

    # -- differences ----------------------------------------------------------
    def changes(self, old: int, new: int) -> DataFrame:
        """(key, change, changed_columns) of the rows that are not the same in two versions.

        ``change`` is inserted, deleted or updated; ``changed_columns`` names, in the table's
        order, the columns whose values differ (audit columns aside), null unless updated.
        Both versions are read by bucket, so nothing is shuffled on a table bucketed on its
        key. Rows with a null key have no counterpart: those of the newer version count as
        inserted, those of the older one as deleted. A key is expected once a version.
        """
        if not self.key:
            raise ValueError(f"{self.data} has no key to tell rows by")
        log = self.log()
        a, b = self.as_of_version(old, log), self.as_of_version(new, log)
        rest = [c for c in b.columns if c != self.key and not c.startswith("record_")]
        left = a.select(self.key, F.struct(*rest).alias("_old"), F.lit(True).alias("_in_old"))
        right = b.select(F.col(self.key).alias("_key"), F.struct(*rest).alias("_new"), F.lit(True).alias("_in_new"))
        both = left.join(right, F.col(self.key) == F.col("_key"), "full_outer")
        differ = F.array_compact(F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in rest]))
        change = F.when(F.col("_in_old").isNull(), "inserted").when(F.col("_in_new").isNull(), "deleted").when(F.size(differ) > 0, "updated")
        told = both.select(F.coalesce(F.col(self.key), F.col("_key")).alias(self.key), change.alias("change"), differ.alias("changed_columns"))
        return told.filter("change IS NOT NULL").withColumn("changed_columns", F.when(F.col("change") == "updated", F.array_join("changed_columns", ",")))

    # -- retention ------------------------------------------------------------
    def expired(self, retain_hours: int, now) -> DataFrame:
        """Versions a retention of ``retain_hours`` would remove (dry run).

        A version is past its time once it was superseded (next commit's timestamp) before
        ``now - retain_hours``; the latest version is never superseded. It expires when all
        later versions of its chain are past their time too, since those are read through
        it. Versions whose data is gone already are not listed again.
        """
        cutoff = _ts(now) - _dt.timedelta(hours=retain_hours)
        h = self.spark.table(self.hist)
        w = Window.orderBy("version")  # one row per commit: the history is tiny
        full = (F.col("operation") != "MERGE") if self.key else F.lit(True)
        chains = (h.withColumn("superseded_at", F.lead("timestamp").over(w))
                  .withColumn("chain", F.max(F.when(full, F.col("version"))).over(w)))
        # the last version of a chain is the last to be superseded; the latest of all never is
        whole = Window.partitionBy("chain")
        done = F.max("superseded_at").over(whole)
        never = F.max(F.col("superseded_at").isNull()).over(whole)
        return (chains.withColumn("done", F.when(~never, done))
                .filter(F.col("done") < F.lit(cutoff).cast("timestamp_ntz"))
                .filter(F.col("version").isin(sorted(self._partition_versions())))
                .select("version", "timestamp", "superseded_at", "num_rows"))

    def vacuum(self, retain_hours: int, now) -> list[int]:
        """Drop the data of expired versions (their partitions and files) and of folders
        without a history row, which a failed commit leaves. Returns the expired versions.

        One writer a table: a commit under way has no history row yet, so retention
        must not run beside it.
        """
        gone = [r["version"] for r in self.expired(retain_hours, now).select("version").collect()]
        known = {r["version"] for r in self.spark.table(self.hist).select("version").collect()}
        orphans = self._partition_versions() - known
        index = self.index
        for v in sorted({*gone, *orphans}):
            self.spark.sql(f"ALTER TABLE {self.data} DROP IF EXISTS PARTITION (_version={v})")
        if index:
            index.remove(sorted({*gone, *orphans}))
        return gone
