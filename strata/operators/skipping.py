"""Skipping files: per-file ranges and Bloom filters in tables beside the data.

``<table>_files`` has a row for each data file: its rows and the least and greatest value
of each indexed column. ``<table>_blooms`` has the bits of a Bloom filter for each file and
column, in parts of 4 KB: a value's hash names one part and three bits in it, so a lookup
touches one part a file, and no task holds a filter as a whole. A filter has at most
``MOST_PARTS`` parts; beyond that it lets more through. Both tables are partitioned by
``_version`` like the data of a snapshot table, so a version's index is written from that
version's files alone and goes with it.

A reader asks which files can hold a value (``files_with``) or any of a table of keys
(``files_of_keys``) and scans only those: the filter on ``_metadata.file_path`` is resolved
when files are listed, and a bucketed scan stays one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.tables import Warehouse

PART_BITS = 1 << 15
MOST_PARTS = 1024
BITS_A_VALUE = 10


def _hash(value: Column) -> Column:
    return F.xxhash64(value)


def _bits(h: Column) -> list[Column]:
    return [F.shiftright(h, s).bitwiseAND(F.lit(PART_BITS - 1)) for s in (0, 15, 30)]


def _part(h: Column, parts: Column) -> Column:
    return F.pmod(F.shiftright(h, 45), parts.cast("long"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, at.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def may_hold(bits: Column, value: Column) -> Column:
    """Whether a part's bits can hold ``value`` (never false for one that is in)."""
    out = F.lit(True)
    for at in _bits(_hash(value)):
        out = out & _is_set(bits, at)
    return out


class FileIndex:
    """The index of one table: ranges and Bloom filters of ``columns``."""

    def __init__(self, wh: Warehouse, layer: str, table: str, columns: list[str]):
        self.wh, self.layer, self.table = wh, layer, table
        self.columns = list(columns)
        self.files, self.blooms = f"{table}_files", f"{table}_blooms"

    # -- writing ---------------------------------------------------------------
    def drop(self) -> None:
        self.wh.drop(self.layer, self.files)
        self.wh.drop(self.layer, self.blooms)

    def add(self, version: int = 0) -> None:
        """Index the files of one version (of all the table if it has no versions)."""
        data = self.wh.table(self.layer, self.table)
        if "_version" in data.columns:
            data = data.filter(F.col("_version") == F.lit(version).cast("long"))
        data = data.select(F.col("_metadata.file_path").alias("file_path"), *self.columns)
        stamp = F.lit(version).cast("long").alias("_version")
        ranges = []
        for c in self.columns:
            ranges += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
        files = data.groupBy("file_path").agg(F.count(F.lit(1)).alias("num_rows"), *ranges)
        # one size of filters a version: its largest file's
        largest = files.agg(F.max("num_rows")).first()[0] or 1
        parts = 1
        while parts < MOST_PARTS and parts * PART_BITS < largest * BITS_A_VALUE:
            parts *= 2
        self.wh.save(files.select("*", F.lit(parts).alias("parts"), stamp), self.layer, self.files, mode="append", partition_by=["_version"])
        blooms = None
        for c in self.columns:
            h = _hash(F.col(c))
            hashed = data.filter(F.col(c).isNotNull()).select("file_path", _part(h, F.lit(parts)).alias("part"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(h))])
            three = hashed.groupBy("file_path", "part").agg(F.array(*[F.bitmap_construct_agg(f"b{i}") for i in range(3)]).alias("bits"))
            one = three.select("file_path", "part", F.explode("bits").alias("bits")).groupBy("file_path", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
            one = one.select("file_path", F.lit(c).alias("column_name"), "part", "bits")
            blooms = one if blooms is None else blooms.unionByName(one)
        self.wh.save(blooms.select("*", stamp), self.layer, self.blooms, mode="append", partition_by=["_version"])

    def remove(self, versions: list[int]) -> None:
        for table in (self.files, self.blooms):
            for v in versions:
                self.wh.spark.sql(f"ALTER TABLE {self.wh.name(self.layer, table)} DROP IF EXISTS PARTITION (_version={v})")

    # -- asking ------------------------------------------------------------------
    def _of(self, table: str, versions: tuple[int, int] | None) -> DataFrame:
        df = self.wh.table(self.layer, table)
        return df if versions is None else df.filter(F.col("_version").between(*versions))

    def files_with(self, values: dict[str, object], ranges: dict[str, tuple] | None = None, versions: tuple[int, int] | None = None) -> list[str]:
        """Files that can hold a row with all the given values, and with columns within
        the given (least, greatest) ranges. Null matches nothing."""
        files = self._of(self.files, versions)
        for c, (low, high) in (ranges or {}).items():
            files = files.filter((F.col(f"{c}_max") >= F.lit(low)) & (F.col(f"{c}_min") <= F.lit(high)))
        kinds = dict(self.wh.table(self.layer, self.table).dtypes)
        for c, v in values.items():
            value = F.lit(v).cast(kinds[c])
            found = files.filter((F.col(f"{c}_min") <= value) & (value <= F.col(f"{c}_max"))).withColumn("part", _part(_hash(value), F.col("parts")))
            bits = self._of(self.blooms, versions).filter(F.col("column_name") == c).select("file_path", "part", "bits")
            files = found.join(bits, ["file_path", "part"]).filter(may_hold(F.col("bits"), value)).drop("part", "bits")
        return [r[0] for r in files.select("file_path").distinct().collect()]

    def files_of_keys(self, keys: DataFrame, column: str, buckets: int, versions: tuple[int, int] | None = None) -> list[str]:
        """Files of a table bucketed on ``column`` that can hold any of the keys.

        A key meets the files of its own bucket only (one a version), then their ranges,
        then their Bloom filters.
        """
        files = self._of(self.files, versions).filter(F.col(f"{column}_min").isNotNull()).select(
            "file_path", "parts", F.col(f"{column}_min").alias("low"), F.col(f"{column}_max").alias("high"), F.pmod(F.hash(f"{column}_min"), F.lit(buckets)).alias("bucket"))
        kind = dict(self.wh.table(self.layer, self.table).dtypes)[column]
        asked = keys.select(F.col(column).cast(kind).alias("value")).filter(F.col("value").isNotNull()).distinct().withColumn("bucket", F.pmod(F.hash("value"), F.lit(buckets)))
        near = asked.join(files, "bucket").filter(F.col("value").between(F.col("low"), F.col("high")))
        near = near.select("file_path", "value", _part(_hash(F.col("value")), F.col("parts")).alias("part"))
        bits = self._of(self.blooms, versions).filter(F.col("column_name") == column).select("file_path", "part", "bits")
        hit = near.join(bits, ["file_path", "part"]).filter(may_hold(F.col("bits"), F.col("value")))
        return [r[0] for r in hit.select("file_path").distinct().collect()]

    def count(self, versions: tuple[int, int] | None = None) -> int:
        return self._of(self.files, versions).count()


def only_files(df: DataFrame, files: list[str]) -> DataFrame:
    """``df`` (a scan of a table) without the files that are not listed."""
    return df.filter(F.col("_metadata.file_path").isin(files) if files else F.lit(False))


def scanned_files(df: DataFrame) -> int:
    """Data files that the last run of ``df``'s own plan read (for tests and reports)."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numFiles").value()
        todo += [node.plan()] if name.endswith("QueryStageExec") else []
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total
