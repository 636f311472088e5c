"""Physical layout: partitioned tables, partition pruning, repartition / coalesce,
reuse through persist, file statistics and multi-column (z-order) clustering."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import Warehouse


# -- partitioned tables --------------------------------------------------------

def with_date_parts(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))


def write_partitioned(wh: Warehouse, df: DataFrame, layer: str, name: str, date_col: str) -> DataFrame:
    """Table partitioned by the year and month of ``date_col``.

    A ``rebalance`` on the partition columns clusters rows by partition first (each
    task writes few folders, no small-file explosion) while AQE splits a hot
    month over several tasks and merges tiny ones, so a month holding a third
    of the data does not land in one task.
    """
    parts = with_date_parts(df, date_col).hint("rebalance", "year", "month")
    return wh.save(parts, layer, name, partition_by=["year", "month"])


def partition_listing(spark: SparkSession, table: str) -> DataFrame:
    """``SHOW PARTITIONS`` parsed into typed (year, month) columns; the folder of rows
    without a date gives NULL."""
    p = spark.sql(f"SHOW PARTITIONS {table}")
    return p.select(
        F.regexp_extract("partition", r"year=(\d+)", 1).try_cast("int").alias("year"),
        F.regexp_extract("partition", r"month=(\d+)", 1).try_cast("int").alias("month"))


def _as_date(v) -> _dt.date:
    return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v))


def date_partition_filter(date_col: str, op: str, value, value2=None) -> Column:
    """A predicate on ``date_col`` plus the implied year / month predicates.

    A filter on the date alone cannot prune a table partitioned by (year, month);
    adding the derived partition predicates lets the scan skip folders while the
    date predicate keeps the exact rows. ``op``: = < <= > >= between.
    """
    d = _as_date(value)
    y, m = F.col("year"), F.col("month")
    c = F.col(date_col)
    lit_d = F.lit(d)

    def at_or_after(x: _dt.date) -> Column:
        return (y > x.year) | ((y == x.year) & (m >= x.month))

    def at_or_before(x: _dt.date) -> Column:
        return (y < x.year) | ((y == x.year) & (m <= x.month))

    if op == "=":
        return (y == d.year) & (m == d.month) & (c == lit_d)
    if op in (">", ">="):
        return at_or_after(d) & (c > lit_d if op == ">" else c >= lit_d)
    if op in ("<", "<="):
        return at_or_before(d) & (c < lit_d if op == "<" else c <= lit_d)
    if op == "between":
        d2 = _as_date(value2)
        return at_or_after(d) & at_or_before(d2) & c.between(lit_d, F.lit(d2))
    raise ValueError(f"unsupported operator {op}")


def calendar(fact: DataFrame, date_col: str) -> DataFrame:
    """One row for each month folder of a partitioned table: year, month, quarter, first day.

    It is read from the folders' names (a distinct over partition columns only), not from rows.
    """
    first = F.make_date("year", "month", F.lit(1))
    return fact.select("year", "month").distinct().filter(F.col("month").isNotNull()).select(
        "year", "month", F.quarter(first).alias("quarter"), first.alias("month_start"), (F.month(first) == 12).alias("year_end"))


def join_months(fact: DataFrame, months: DataFrame) -> DataFrame:
    """``fact`` (partitioned by year and month) in the months of a filtered calendar.

    An equi-join on the partition columns: the planner turns the filtered calendar into a
    ``dynamicpruningexpression`` of the fact's scan, so folders of other months are not read,
    although no predicate on the fact names a month.
    """
    return fact.join(months.select("year", "month", "quarter"), ["year", "month"])


def count_by(df: DataFrame, key: str, name: str = "sales_count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


# -- repartition / coalesce -----------------------------------------------------

def partition_profile(df: DataFrame, layout: str) -> DataFrame:
    """(layout, partitions, rows): non-empty partitions and total rows, computed by the job itself."""
    per = df.groupBy(F.spark_partition_id().alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.count(F.lit(1)).alias("partitions"), F.sum("_n").alias("rows")).select(
        F.lit(layout).alias("layout"), "partitions", "rows")


def layouts(df: DataFrame, key: str, n: int = 20, n_key: int = 10, n_small: int = 4, tasks: int = 1) -> dict[str, DataFrame]:
    """Round-robin to ``n``, hash on ``key`` to ``n_key``, coalesce ``n`` down to ``n_small``,
    and the 'coalesce cannot grow' case (``n`` to ``2n`` stays ``n``).

    ``n`` and the others are the counts named in the result, whatever the data's size. Only a
    caller that names a higher count itself (``tasks``) gets no layout with fewer; hashing
    then goes by key and a row hash within as many salts as a task's share asks for. A count
    out of :func:`tasks_for` has no place here: the result would change with the input.
    """
    rr = df.repartition(max(n, tasks))
    by_key = df.repartition(n_key, key) if tasks <= n_key else df.repartition(
        tasks, key, F.pmod(F.xxhash64(*df.columns), F.lit(-(-tasks // n_key))))
    return {
        f"repartition_{n}": rr,
        f"repartition_{n_key}_by_{key}": by_key,
        f"coalesce_{n_small}_from_{n}": rr.coalesce(max(n_small, tasks)),
        f"coalesce_{2 * n}_from_{n}": rr.coalesce(2 * max(n, tasks)),
    }


# -- reuse ------------------------------------------------------------------------

@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist and materialize once; inside the block actions read the cached blocks
    (``InMemoryTableScan``), and a lost block is recomputed from lineage. The blocks are
    released at the end."""
    df = df.persist(level)
    try:
        df.count()
        yield df
    finally:
        df.unpersist()


# -- file statistics ----------------------------------------------------------------

def file_stats(df: DataFrame) -> DataFrame:
    """(num_files, size_in_bytes, num_rows) of a file-backed table.

    Files and their sizes come from a listing of the table's paths (the ``binaryFile``
    source without its content column reads no data), rows from a count that the Parquet
    footers answer; no row carries a path.
    """
    spark = df.sparkSession
    files = spark.read.format("binaryFile").load(df.inputFiles()).select(F.lit(1).alias("num_files"), F.col("length").alias("size_in_bytes"), F.lit(0).alias("num_rows"))
    rows = df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(0).alias("num_files"), F.lit(0).cast("long").alias("size_in_bytes"), "num_rows")
    return files.unionByName(rows).agg(*[F.sum(c).alias(c) for c in ("num_files", "size_in_bytes", "num_rows")])


def tasks_for(df: DataFrame, target_bytes: int) -> int:
    """Number of files (or tasks) of about ``target_bytes`` that a file-backed frame is worth."""
    size = file_stats(df).first()["size_in_bytes"] or 0
    return max(1, -(-size // target_bytes))


def file_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per-file min / max of ``cols`` (what a reader uses to skip files)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*aggs)


# -- z-order ------------------------------------------------------------------------

def _numeric(c: str, dtype: str) -> Column:
    if dtype == "string":  # by its first 6 bytes, in byte order
        return F.conv(F.hex(F.substring(F.rpad(F.encode(F.col(c), "UTF-8"), 6, F.lit(b"\x00")), 1, 6)), 16, 10).cast("double")
    if dtype == "date":
        return F.unix_date(F.col(c)).cast("double")
    if dtype.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def zorder_key(df: DataFrame, cols: list[str], bits: int = 8) -> DataFrame:
    """Add ``_z``: bit-interleaved range ids of ``cols``.

    Each column is mapped to one of 2**bits quantile ranges (approximate
    quantiles: one pass, bounded memory, 2**bits boundaries per column), so a
    skewed column still spreads over all ranges. The interleave is plain
    shift / and / or expressions (whole-stage codegen).
    """
    from pyspark.ml.feature import QuantileDiscretizer

    dtypes = dict(df.dtypes)
    num = df
    for c in cols:
        num = num.withColumn(f"_zn_{c}", _numeric(c, dtypes[c]))
    qd = QuantileDiscretizer(numBuckets=2 ** bits, inputCols=[f"_zn_{c}" for c in cols],
                             outputCols=[f"_zb_{c}" for c in cols], handleInvalid="keep", relativeError=0.001)
    bucketed = qd.fit(num).transform(num)
    z = F.lit(0).cast("long")
    n = len(cols)
    for i in range(bits):
        for j, c in enumerate(cols):
            bit = F.shiftright(F.col(f"_zb_{c}").cast("long"), i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * n + j))
    drop = [f"_zn_{c}" for c in cols] + [f"_zb_{c}" for c in cols]
    return bucketed.withColumn("_z", z).drop(*drop)


def zorder_cluster(df: DataFrame, cols: list[str], files: int, bits: int = 8) -> DataFrame:
    """Compact into ``files`` (see :func:`tasks_for`) range partitions of the z-value, sorted inside each file,
    so per-file min / max of every clustered column narrow together.

    A row hash breaks ties in the range bounds, so rows sharing one z-value (a
    hot combination of the clustered columns) still split over several files.
    """
    return (zorder_key(df, cols, bits).withColumn("_tie", F.xxhash64(*df.columns))
            .repartitionByRange(files, "_z", "_tie")
            .sortWithinPartitions("_z").drop("_z", "_tie"))
