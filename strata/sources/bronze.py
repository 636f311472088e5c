"""Bronze layer: metadata-driven ingestion of raw CSV extracts into string tables."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expressions import ntz
from strata.sources.tables import Warehouse

CONFIG_SCHEMA = T.StructType([
    T.StructField("FilePath", T.StringType()),
    T.StructField("TargetTableName", T.StringType()),
])


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON ingestion config: one (FilePath, TargetTableName) object per entry."""
    return spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).json(path)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column kept as string (no schema inference pass over the data)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


CORRUPT = "_corrupt_record"


def read_guarded_csv(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """A CSV extract of known columns, all text, with the whole line in ``_corrupt_record``
    where it has not as many fields as there are columns.

    Columns are not pruned in the parser: it could not see what is wrong with a line of
    which it reads some fields only.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))


def damage(line: str | Column, columns: int) -> Column:
    """Why a line is set apart: an open quote, or too few or too many fields."""
    text = F.col(line) if isinstance(line, str) else line
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    # commas outside quotes: those of the line without its quoted parts
    bare = F.regexp_replace(text, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.when(quotes % 2 == 1, "open quote").when(fields < columns, "too few fields").when(fields > columns, "too many fields").otherwise("unreadable")


def load_guarded(wh: Warehouse, path: str, table: str, columns: list[str], load_ts: str | None = None, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Load one extract; damaged lines go to ``<table>_quarantine`` and not into the table.

    Returns (table, quarantine). The quarantine has (line, first_field, reason,
    ingestion_timestamp, source_file_name), so each line can be mended and loaded again. Each side is one pass over
    the extract that Spark deals out by its splits.
    """
    parsed = read_guarded_csv(wh.spark, path, columns, header)
    good = parsed.filter(F.col(CORRUPT).isNull()).select(*columns)
    # the parser refuses a read of this column alone, so the first field comes along
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("line"), F.col(columns[0]).alias("first_field"), damage(CORRUPT, len(columns)).alias("reason"))
    name = file_name(path)
    return wh.save(stamp(good, name, load_ts), "bronze", table), wh.save(stamp(bad, name, load_ts), "bronze", f"{table}_quarantine")


def file_name(path: str) -> str:
    """Last segment of the configured path (not ``_metadata.file_name``, which names part files)."""
    return path.rstrip("/").split("/")[-1]


def stamp(df: DataFrame, source_file: str, load_ts: str | None) -> DataFrame:
    """Add the two audit columns; ``load_ts`` None means the query's current timestamp."""
    ts = ntz(load_ts) if load_ts else F.localtimestamp()
    return df.withColumn("ingestion_timestamp", ts).withColumn("source_file_name", F.lit(source_file))


def ingest(wh: Warehouse, config_path: str, load_ts: str | None = None, workers: int = 1) -> dict[str, str]:
    """Load every configured file into ``bronze.<TargetTableName>`` (overwrite).

    The config is a handful of rows, so collecting it is bounded; each load is
    its own distributed CSV -> Parquet job, and up to ``workers`` of them are
    submitted at once (they are independent).
    """
    wh.ensure_layers()
    rows = read_config(wh.spark, config_path).select("FilePath", "TargetTableName").collect()

    def load(row) -> tuple[str, str]:
        df = stamp(read_raw_csv(wh.spark, row["FilePath"]), file_name(row["FilePath"]), load_ts)
        wh.save(df, "bronze", row["TargetTableName"])
        return row["TargetTableName"], wh.name("bronze", row["TargetTableName"])

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return dict(pool.map(load, rows))


def write_config(spark: SparkSession, path: str, entries: list[tuple[str, str]]) -> str:
    """Write a multi-line JSON config (a JSON array of objects) through Spark's file system."""
    text = json.dumps([{"FilePath": p, "TargetTableName": t} for p, t in entries], indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


#: rows of a landed file, at most: a compressed file is read by one task
FILE_ROWS = 1_000_000


def land_raw(wh: Warehouse, extracts: dict[str, DataFrame], workers: int = 1, config: str = "metadata_config.json") -> str:
    """Write each extract as a header CSV under ``<root>/raw_data/<name>.csv`` plus the config.

    Stands in for the files an upstream system drops; returns the config path. The files
    are compressed, as text takes several times the bytes of any later layer.
    """
    def land(item) -> tuple[str, str]:
        name, df = item
        p = f"{wh.root}/raw_data/{name}.csv"
        df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", FILE_ROWS).csv(p, compression="gzip")
        return p, f"raw_{name}"

    with ThreadPoolExecutor(max(1, workers)) as pool:
        entries = list(pool.map(land, extracts.items()))
    return write_config(wh.spark, f"{wh.root}/raw_data/{config}", entries)


def lookup(df: DataFrame, column: str, value: int) -> DataFrame:
    """``where <string col> = <integer>``: compare as a number like the implicit cast, NULL for non-numbers.

    Any text that casts to ``value`` contains the decimal digits of its absolute value
    (padding, a sign, blanks and a fraction only add characters around them), so
    ``contains`` is an implied predicate the Parquet scan can evaluate; the cast keeps
    the exact rows.
    """
    return df.filter(F.col(column).contains(str(abs(value))) & (F.expr(f"try_cast({column} as bigint)") == F.lit(value)))


def bronze_counts(wh: Warehouse, tables: dict[str, str]) -> DataFrame:
    """(target_table, source_file_name, row_count) per bronze table, one union of aggregates."""
    parts = [
        wh.spark.table(full).groupBy("source_file_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t).alias("target_table"), "source_file_name", "row_count")
        for t, full in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
