"""The queries of this subpackage: thin digests over the operators' own outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import alignment, bpe, collocations, curriculum, decontam, htmltext, jaccard, langid, oracles, ring, suffixdedup, syncmers, toxicity, warc
from strata.llm.common import ship

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")), F.lit(n))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder("doc_id", 3) == 1
    model = langid.fit(docs.where(~held).select(F.col("doc_id").alias("id"), "text", "lang"))
    return langid.predict(docs, model).withColumn("held_out", remainder("doc_id", 3) == 1).select("doc_id", "held_out", "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    model = toxicity.fit(docs.select(F.col("doc_id").alias("id"), "text"), labels)
    return toxicity.score(docs, model).withColumn("held_out", remainder("doc_id", 4) == 2).select("doc_id", "held_out", "score", "predicted")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.cleaned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_neighbours(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), bpe.TOKENIZER)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.assign(table(spark, sf_dir, "documents"), shards=16)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return curriculum.by_first_position(mixed).select("doc_id", "size", "source_size", "target", "taken", "position")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_warc": op6_warc,
    "op7_bpe": op7_bpe,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_sharding": op9_sharding,
    "op10_html_text": op10_html_text,
    "op11_curriculum_mix": op11_curriculum_mix,
    "op12_collocations": op12_collocations,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {"op11_curriculum_mix": oracles.CURRICULUM_MIX, "op12_collocations": oracles.COLLOCATIONS}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
