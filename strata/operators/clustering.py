"""A table clustered on a column, kept clustered by increments.

Rows are appended in runs: each a partition folder whose files are range-clustered on the
column, with a file index of their ranges. Every run's files overlap those of others, and
the most ranges over one value (the depth, from a sweep over the files' ends) says how
many files a lookup has to open. When the depth passes a limit, the smallest runs, and only as
many as it takes, are rewritten as one; what is large and narrow stays as it is. So a row
is rewritten when its run has grown by a factor, not at every append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.layout import file_stats
from strata.operators.skipping import FileIndex, only_files
from strata.sources.tables import Warehouse


class ClusteredTable:
    def __init__(self, wh: Warehouse, layer: str, name: str, column: str, target_bytes: int, most_depth: int = 4):
        self.wh, self.layer, self.name, self.column = wh, layer, name, column
        self.target_bytes, self.most_depth = target_bytes, most_depth
        self.index = FileIndex(wh, layer, name, [column])

    def drop(self) -> None:
        self.wh.drop(self.layer, self.name)
        self.index.drop()

    # -- writing -----------------------------------------------------------------
    def _runs(self) -> list[int]:
        if not self.wh.exists(self.layer, self.name):
            return []
        return sorted(int(r[0].split("=", 1)[1]) for r in self.wh.spark.sql(f"SHOW PARTITIONS {self.wh.name(self.layer, self.name)}").collect())

    def _write(self, df: DataFrame, files: int) -> int:
        run = max(self._runs(), default=-1) + 1
        tie = F.xxhash64(*df.columns)  # a hot value is split over files
        sorted_ = df.withColumn("_tie", tie).repartitionByRange(files, self.column, "_tie").sortWithinPartitions(self.column, "_tie").drop("_tie")
        self.wh.save(sorted_.withColumn("_version", F.lit(run).cast("long")), self.layer, self.name, mode="append", partition_by=["_version"])
        self.index.add(run)
        return run

    def append(self, df: DataFrame, files: int = 1) -> int:
        """Add rows as a run of ``files`` files; returns the run's number."""
        return self._write(df, files)

    # -- reading -------------------------------------------------------------------
    def rows(self) -> DataFrame:
        return self.wh.table(self.layer, self.name).drop("_version")

    def lookup(self, value) -> DataFrame:
        """Rows with ``column = value`` out of the files that can hold it."""
        df = only_files(self.wh.table(self.layer, self.name), self.index.files_with({self.column: value}))
        return df.filter(F.col(self.column) == F.lit(value)).drop("_version")

    # -- overlap -------------------------------------------------------------------
    def _files(self, runs: list[int] | None = None) -> DataFrame:
        files = self.wh.table(self.layer, self.index.files).filter(F.col(f"{self.column}_min").isNotNull())
        return files if runs is None else files.filter(F.col("_version").isin(runs))

    def depth(self, runs: list[int] | None = None) -> int:
        """The most files whose ranges share a value: a sweep over the ends of the ranges.

        It reads the index, a row a file. A range ends after all that begin at its end."""
        c = self.column
        ends = self._files(runs).select(F.explode(F.array(
            F.struct(F.col(f"{c}_min").alias("at"), F.lit(0).alias("late"), F.lit(1).alias("step")),
            F.struct(F.col(f"{c}_max").alias("at"), F.lit(1).alias("late"), F.lit(-1).alias("step")))).alias("e")).select("e.*")
        sweep = Window.orderBy("at", "late").rowsBetween(Window.unboundedPreceding, 0)
        return ends.withColumn("open", F.sum("step").over(sweep)).agg(F.max("open")).first()[0] or 0

    def runs_to_join(self) -> list[int]:
        """The smallest runs, as few as leave room for the next append when they are one.

        What stays and one layer on top of it are then below the limit, or are the largest
        run and that layer, which is as flat as it gets without rewriting the largest run."""
        runs = self._runs()
        if len(runs) < 2 or self.depth() <= self.most_depth:
            return []
        sizes = {r["_version"]: r["n"] for r in self._files().groupBy("_version").agg(F.sum("num_rows").alias("n")).collect()}
        by_size = sorted(runs, key=lambda r: (sizes.get(r, 0), r))
        goal = max(self.depth(by_size[-1:]) + 1, self.most_depth - 1)
        for k in range(2, len(by_size)):
            if self.depth(by_size[k:]) + 1 <= goal:
                return by_size[:k]
        return by_size

    def recluster(self) -> tuple[int, int]:
        """Join what ``runs_to_join`` picks into one run; returns (files rewritten, files before).

        The new run is written before the old ones go. A run that died in between leaves both;
        rows are then there twice, so a writer that restarts calls ``repair`` first."""
        before = self.index.count()
        picked = self.runs_to_join()
        if not picked:
            return 0, before
        gone = self._files(picked).count()
        old = self.wh.table(self.layer, self.name).filter(F.col("_version").isin(picked))
        files = max(1, -(-(file_stats(old).first()["size_in_bytes"] or 0) // self.target_bytes))
        new = self._write(old.drop("_version"), files)
        self.wh.set_property(self.layer, self.name, "strata.joined", f"{new}:{','.join(map(str, picked))}")
        self._forget(picked)
        return gone, before

    def _forget(self, runs: list[int]) -> None:
        for r in runs:
            self.wh.spark.sql(f"ALTER TABLE {self.wh.name(self.layer, self.name)} DROP IF EXISTS PARTITION (_version={r})")
        self.index.remove(runs)
        self.wh.set_property(self.layer, self.name, "strata.joined", "")

    def repair(self) -> None:
        """After a writer died: a join whose new run was complete is carried out."""
        note = self.wh.property_of(self.layer, self.name, "strata.joined")
        if note:
            self._forget([int(r) for r in note.split(":")[1].split(",")])
