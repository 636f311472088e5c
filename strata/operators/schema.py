"""Schema listing and appends with schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """An append whose columns or types do not fit the target table."""


def schema_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) of a DataFrame's schema."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, position, column_name, data_type, num_rows, nulls, min_value, max_value) of every column.

    The schema listing with what is in the columns: one aggregate over the table, whose tasks
    send one row each, and its only row turned into one a column. Values are shown as text.
    """
    fields = df.schema.fields
    sums = [F.count(F.lit(1)).alias("num_rows")]
    for i, f in enumerate(fields):
        sums += [F.count_if(F.col(f.name).isNull()).alias(f"n{i}"), F.min(f.name).cast("string").alias(f"a{i}"), F.max(f.name).cast("string").alias(f"z{i}")]
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"n{i}").alias("nulls"), F.col(f"a{i}").alias("min_value"), F.col(f"z{i}").alias("max_value")) for i, f in enumerate(fields)]
    return df.agg(*sums).select("num_rows", F.explode(F.array(*rows)).alias("c")).select(
        F.lit(table).alias("table_name"), "c.position", "c.column_name", "c.data_type", "num_rows", "c.nulls", "c.min_value", "c.max_value")


def check_append(target: T.StructType, incoming: T.StructType) -> list[str]:
    """Problems that block an append: unknown columns and type changes (names are case-insensitive).
    Columns missing from ``incoming`` are fine: they are filled with NULL."""
    tgt = {f.name.lower(): f for f in target.fields}
    problems = []
    for f in incoming.fields:
        t = tgt.get(f.name.lower())
        if t is None:
            problems.append(f"unknown column {f.name}")
        elif f.dataType != t.dataType and not isinstance(f.dataType, T.NullType):
            problems.append(f"column {f.name}: {f.dataType.simpleString()} cannot be written to "
                            f"{t.dataType.simpleString()}")
    return problems


def align(target: T.StructType, df: DataFrame) -> DataFrame:
    """``df`` in the target's column order and types; missing columns as typed NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select([
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ])


def guarded_append(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """Append ``df`` to ``table`` only when its schema fits; raise :class:`SchemaMismatch` otherwise."""
    target = spark.table(table).schema
    problems = check_append(target, df.schema)
    if problems:
        raise SchemaMismatch(f"append to {table} rejected: " + "; ".join(problems))
    align(target, df).write.mode("append").format("parquet").saveAsTable(table)
    return spark.table(table)
