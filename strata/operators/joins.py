"""Join strategies for a fact and a dimension: planner-chosen, size-checked broadcast,
salted, and heavy-key split; plus the key-frequency operators that find skew.

All variants return exactly the rows of the plain inner equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import shared_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder (reliable, cuts lineage)."""
    shared_dir(df.sparkSession)  # make sure the context has the session's checkpoint folder
    return df.checkpoint(eager=True)


def byte_size(df: DataFrame) -> int:
    """Estimated bytes of ``df`` in memory: text and binary columns by their lengths, 16 for
    each other column and row. One aggregate whose tasks each return one row."""
    width = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    return df.agg(F.sum(width.cast("long")).alias("n")).first()["n"] or 0


def join_auto(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Leave the strategy to Catalyst / AQE (auto-broadcast below the size threshold)."""
    return fact.join(dim, key, "inner")


def join_broadcast(fact: DataFrame, dim: DataFrame, key: str, max_bytes: int) -> DataFrame:
    """Broadcast hint on ``dim`` only if its measured size is within the bound; otherwise the shuffle join."""
    if byte_size(dim) <= max_bytes:
        return fact.join(F.broadcast(dim), key, "inner")
    return join_auto(fact, dim, key)


def key_counts(fact: DataFrame, key: str, name: str = "row_count") -> DataFrame:
    """Rows per key (partial aggregation before the shuffle, so a hot key costs one row per task)."""
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_keys(fact: DataFrame, key: str, k: int, name: str = "row_count") -> DataFrame:
    """The ``k`` most frequent keys; the key breaks ties so the report is stable."""
    return key_counts(fact, key, name).orderBy(F.desc(name), F.asc(key)).limit(k)


def heavy_keys(fact: DataFrame, key: str, threshold: int, name: str = "row_count") -> DataFrame:
    """Keys with more than ``threshold`` rows (``HAVING COUNT(*) > threshold``)."""
    return key_counts(fact, key, name).filter(F.col(name) > threshold)


def hot_keys(fact: DataFrame, key: str, threshold: int, most: int = 10_000) -> DataFrame:
    """The keys worth treating apart: more rows than ``threshold`` and than 1 / ``most`` of all.

    Fewer than ``most`` keys can hold more than that share, whatever the data, so the
    set is small enough to broadcast by construction. It is checkpointed to the shared
    folder: one pass over the fact, no replay after an executor loss. NULL keys join
    nothing and are left out.
    """
    least = max(threshold, fact.count() // most)
    return checkpointed(heavy_keys(fact.filter(F.col(key).isNotNull()), key, least).select(key))


def summary(keys: pa.Array, counters: dict, size: int) -> dict:
    """A Misra-Gries summary with a batch of keys taken in: at most ``size`` counters.

    Equal keys are counted first; then the ``size + 1``-th greatest counter is taken off
    all, and those left without go. A counter is below its key's rows by at most
    rows / (size + 1), and summaries can be merged by adding them up.
    """
    for item in pc.value_counts(keys.drop_null()).to_pylist():
        counters[item["values"]] = counters.get(item["values"], 0) + item["counts"]
    if len(counters) > size:
        less = sorted(counters.values(), reverse=True)[size]
        counters = {k: n - less for k, n in counters.items() if n > less}
    return counters


def frequent_candidates(fact: DataFrame, key: str, most: int) -> DataFrame:
    """Keys that may have more than 1 / ``most`` of all rows, none of them missing.

    Every task keeps a summary of ``2 * most`` counters over its rows and sends these only;
    the counters of all tasks are summed, and what stays below half of the share
    cannot have the whole share. So memory and shuffle follow tasks and ``most``, not the
    number of keys, and fewer than ``2 * most`` keys are returned.
    """
    size = 2 * most
    field = fact.schema[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict = {}
        rows, kind = 0, None
        for batch in batches:
            column = batch.column(0)
            kind = column.type
            rows += len(column) - column.null_count
            counters = summary(column, counters, size)
        if kind is not None:
            out = [pa.array([*counters, None], kind), pa.array([*counters.values(), rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=[key, "n"])

    # a row without a key has the number of rows that the task has seen
    sent = fact.select(key).mapInArrow(run, T.StructType([T.StructField(key, field.dataType), T.StructField("n", T.LongType())]))
    sums = checkpointed(sent.groupBy(key).agg(F.sum("n").alias("n")))
    total = sums.filter(F.col(key).isNull()).select("n").first()
    return sums.filter(F.col(key).isNotNull() & (F.col("n") * (2 * most) > F.lit(total[0] if total else 0))).select(key)


def frequent_keys(fact: DataFrame, key: str, most: int, name: str = "row_count") -> DataFrame:
    """Keys with more than 1 / ``most`` of the rows (null keys aside) and their exact row counts.

    A pass for the candidates (:func:`frequent_candidates`), and one that counts only these:
    they are fewer than ``2 * most`` by construction, so they are broadcast.
    """
    candidates = checkpointed(frequent_candidates(fact, key, most))
    total = fact.filter(F.col(key).isNotNull()).count()
    counted = key_counts(fact.select(key).join(F.broadcast(candidates), key, "left_semi"), key, name)
    return counted.filter(F.col(name) * most > total)


def salt_of(row_id: str, buckets: int):
    """Deterministic salt in [0, buckets): hash of a row id, so a retried task
    salts every row the same way (``rand()`` would not)."""
    return F.pmod(F.xxhash64(F.col(row_id)), F.lit(buckets))


def salted_join(fact: DataFrame, dim: DataFrame, key: str, buckets: int, row_id: str,
                hot: DataFrame | None = None) -> DataFrame:
    """Join on (key, salt): a hot key's fact rows spread over ``buckets`` tasks.

    Without ``hot`` every dim row is replicated ``buckets`` times (the classic
    form). The planner's size of the replicas is that of the dim once, so it would
    broadcast many times what its threshold allows, through the driver: the hint keeps
    this form a shuffle join at any size. With ``hot`` (from :func:`hot_keys`, bounded) only those keys are salted and
    replicated; the rest keep salt 0, so the dim grows by |hot| * (buckets - 1).
    Flagging hot fact rows must not itself shuffle the fact by key (that would
    put the hot key in one task again), so the hot set is broadcast.
    Output = plain join columns (the salt is dropped).
    """
    if hot is None:
        f = fact.withColumn("_salt", salt_of(row_id, buckets))
        d = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).hint("merge")
    else:
        flag = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
        f = (fact.join(flag, key, "left")
             .withColumn("_salt", F.when(F.col("_hot"), salt_of(row_id, buckets)).otherwise(F.lit(0)))
             .drop("_hot"))
        d = (dim.join(flag, key, "left")
             .withColumn("_salt", F.explode(F.sequence(
                 F.lit(0), F.when(F.col("_hot"), F.lit(buckets - 1)).otherwise(F.lit(0)))))
             .drop("_hot"))
    return f.join(d, [key, "_salt"], "inner").drop("_salt")


def split_skew_join(fact: DataFrame, dim: DataFrame, key: str, hot: DataFrame, max_bytes: int,
                    row_id: str, buckets: int = 10) -> DataFrame:
    """Hot keys through a broadcast join, the rest through the regular join, then union.

    ``hot`` (from :func:`hot_keys`) is small by construction, so both halves of the
    fact are told apart by a broadcast and never shuffled by the raw key. The hot half
    joins a broadcast of the dimension's hot rows if their measured size is within
    ``max_bytes``, else the salted join (a plain shuffle join would put each hot key in
    one task).
    """
    clash = (set(fact.columns) & set(dim.columns)) - {key}
    if clash:
        raise ValueError(f"fact and dim share non-key columns {sorted(clash)}; select or rename them first")
    keys = F.broadcast(hot.select(key))
    hot_fact = fact.join(keys, key, "left_semi")
    hot_dim = dim.join(keys, key, "left_semi")
    if byte_size(hot_dim) <= max_bytes:
        hot_part = hot_fact.join(F.broadcast(hot_dim), key)
    else:
        hot_part = salted_join(hot_fact, hot_dim, key, buckets, row_id)
    return hot_part.unionByName(fact.join(keys, key, "left_anti").join(dim, key))


def light_rows(fact: DataFrame, key: str, heavy: DataFrame, max_bytes: int, row_id: str, buckets: int = 10) -> DataFrame:
    """Fact rows whose key is not heavy (``left_anti``).

    The heavy set is any size here (a plain threshold): it is broadcast within
    ``max_bytes``; beyond, the fact is salted and the set replicated, so a hot key
    spreads over ``buckets`` tasks. A NULL key is not heavy: its rows stay.
    """
    keys = checkpointed(heavy.select(key))
    if byte_size(keys) <= max_bytes:
        return fact.join(F.broadcast(keys), key, "left_anti")
    salted = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return fact.withColumn("_salt", salt_of(row_id, buckets)).join(salted, [key, "_salt"], "left_anti").drop("_salt")


def sample_by_group(df: DataFrame, group: str, row_id: str, k: int, parts: int = 64) -> DataFrame:
    """``k`` rows of each group: those with the least MD5 of their id (a bottom-k sample).

    The sample is the same at every run and every partitioning, and samples of parts of the
    data can be merged by taking the least again. First each of ``parts`` slices of a group
    finds its own ``k`` least, then the group's are picked from these, so no task holds a
    group and nothing is sorted as a whole. Null groups are a group.
    """
    keyed = df.withColumn("_h", F.md5(F.col(row_id).cast("string"))).withColumn("_part", F.pmod(F.xxhash64(row_id), F.lit(parts)))
    order = [F.col("_h").asc(), F.col(row_id).asc()]
    for by in ([group, "_part"], [group]):
        keyed = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rank") <= k)
    return keyed.drop("_h", "_part", "_rank")
