import cases
import corpus_pipeline
import pytest

import __spark_entry__ as se
from strata.llm import bpe, jaccard

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = [n.split("_")[0] for n in se.queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in se.queries()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.fixture()
def folder(spark, tmp_path):
    item = cases.prose(700, 30)
    rows = cases.rows()
    rows += [(100 + i, cases.prose(300 + i, 60), "en", "a", 1) for i in range(12)] + [(150, cases.prose(400, 40) + " " + item, "en", "a", 1)]
    spark.createDataFrame(rows, cases.SHAPE).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_on_awkward_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, folder), f"test-{name}")
        if name != "tokens":
            assert out.columns == docs.columns
            kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        docs = out
    assert not {3, 4, 5} & set(kept["language_id"]) and {1, 2, 7, 8, 12, 150} <= set(kept["language_id"])
    assert -7 in kept["near_duplicates"] and not {1, 2, 8} & set(kept["near_duplicates"])
    classes = {r["doc_id"]: r["class_id"] for r in jaccard.classes(spark.createDataFrame(list(kept["language_id"].items()), "doc_id bigint, text string")).collect()}
    assert set(kept["near_duplicates"]) - {None} == {k for k, c in classes.items() if k == c and k is not None}
    shared = cases.prose(1, 40)
    assert shared in kept["near_duplicates"][9] and shared not in kept["long_repeats"][9]
    assert 150 in kept["long_repeats"] and 150 not in kept["benchmark_passages"]
    assert set(kept["benchmark_passages"]) == set(kept["long_repeats"]) - {150}
    ids = {r["doc_id"]: r["ids"] for r in docs.collect()}
    assert set(ids) == set(kept["benchmark_passages"])
    coder = bpe.codec(bpe.tokenizer_file())
    assert all(ids[k] == coder.encode(t).tolist() for k, t in kept["benchmark_passages"].items() if k is not None)


def test_empty_tables(spark, tmp_path):
    cases.nothing(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(n for n in se.queries() if n.startswith("op") or n == "pipeline"))
def test_queries_run_on_the_given_tables(spark, name):
    rows = se.queries()[name](spark, SF)
    table = "pages" if name.startswith(("op6", "op10")) else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "pipeline":
        assert 0 < rows.count() <= n
    elif not name.startswith(("op3_", "op12_")):  # these have rows of their own
        assert rows.count() == n


def test_stages_keep_extra_columns_whatever_their_names(spark, tmp_path):
    from pyspark.sql import functions as F
    docs = cases.documents(spark, clash=True).withColumn("kept", F.lit(5)).withColumn("spans", F.lit("s")).withColumn("lang_pred", F.lit("q")).withColumn("same", F.lit(1)).withColumn("class_id", F.lit("c"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, cases.prose(700, 30))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    plain = cases.documents(spark)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, plain = (corpus_pipeline.written(stage(spark, x, str(tmp_path)), f"clash-{name}") for x in (docs, plain))
        assert sorted(map(str, docs.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
        rest = {str(r) for r in docs.select([c for c in docs.columns if c not in plain.columns]).collect()}
        assert len(rest) == 1 and "score='s'" in rest.pop() and docs.columns[:5] == plain.columns
    assert {f.name: f.dataType.simpleString() for f in docs.schema}["score"] == "string"
