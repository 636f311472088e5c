"""A training-corpus pipeline: five stages over ``documents``, each one of the operators
in ``strata.llm``. Every stage's result is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontam, jaccard, langid, suffixdedup
from strata.llm.common import ship, written

#: a document whose language the model is less sure of goes
LEAST_SCORE = 0.3
#: ids that are sent to all tasks (8 bytes each); more are joined by a shuffle
BROADCAST_IDS = 1_000_000


def _ids(table: DataFrame) -> DataFrame:
    """A written table of ids, with a broadcast hint if it is within the bound."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _apart(docs: DataFrame, *named: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``named`` under names that no operator uses, and the
    columns that give ``docs`` back its own."""
    rest = {c: f"_carried{i}" for i, c in enumerate(docs.columns) if c not in named}
    plain = docs.select(*named, *[docs[c].alias(r) for c, r in rest.items()])
    return plain, [F.col(rest.get(c, c)).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows and is sure of; a null ``lang`` is filled in.

    Texts that are null or have no letter go. The model is fitted on the rows that have
    a language (a bounded sample, see ``langid.Params``). Without any such row nothing
    is judged but the letters.
    """
    ship(spark)
    model = langid.fit(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    plain, back = _apart(docs, "doc_id", "text", "lang")
    return langid.predict(plain, model, carry=True).where(
        (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    ).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id.

    Rows with a null id are not compared and stay; of rows with equal ids and texts one
    stays.
    """
    ship(spark)
    classes = jaccard.classes(docs)
    keep = written(classes.where("class_id = doc_id").select("doc_id").distinct(), "pipeline-kept")
    known = docs.join(_ids(keep), "doc_id", "left_semi").select(*docs.columns)
    twice = written(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "pipeline-twice")
    if twice.limit(1).count():  # texts are grouped for such ids only
        repeated = known.join(_ids(twice), "doc_id", "left_semi").withColumn("_same", F.xxhash64("text")).dropDuplicates(["doc_id", "_same"])
        known = known.join(_ids(twice), "doc_id", "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))
    return known.unionByName(docs.where("doc_id IS NULL"))


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a document with a smaller id has too.

    A character that loses some of its bytes goes whole. Documents of which nothing is
    left go.
    """
    ship(spark)
    plain, back = _apart(docs.drop("n_chars"), "doc_id", "text")
    cleaned = suffixdedup.cleaned(plain, carry=tuple(plain.columns[2:]), as_text=True)
    left = cleaned.where("n_bytes = 0 OR length(trim(kept)) > 0").drop("n_bytes").withColumnRenamed("kept", "text").select(*back)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    ship(spark)
    found = written(decontam.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct(), "pipeline-leaks")
    return docs.join(_ids(found), "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256) of every document that is left: its token
    ids, decoded again to the text whose digest comes along."""
    ship(spark)
    return bpe.encode_documents(docs, bpe.TOKENIZER, decoded=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("long_repeats", long_repeats),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]

#: no stage but the last could be told in SQL over whole tables
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
