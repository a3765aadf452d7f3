"""The pipeline's stages: each takes effect, keeps columns, and works on its own input."""

import pytest

import corpus_pipeline
from tests.llm.test_operators import DOC, ODD, brute_kept
from tidewright.llm import mixing, quality, toxicity
from tidewright.llm.queries import TARGETS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out.append(docs)
    return out


def test_columns_and_order(spark, outputs):
    own = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "dedup", "mixing", "packing"]
    assert all(df.columns == own for df in outputs[:-1])


def test_filters_agree_with_their_operators(spark, outputs):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    assert ids(outputs[0]) == ids(quality.score_documents(docs, labels).filter("predicted = 1"))
    assert ids(outputs[1]) == ids(toxicity.score_documents(outputs[0], labels).filter("predicted = 0"))
    # every pair of the stage's input compared: word 5-grams, similarity 0.8 and more (op9's own query alone has three words and three bits)
    assert ids(outputs[2]) == brute_kept([r.asDict() for r in outputs[1].select("doc_id", "text").collect()])
    taken = mixing.mix(outputs[2], TARGETS, corpus_pipeline.BUDGET_PERCENT, 1).filter("copies > 0")
    assert ids(outputs[3]) == ids(taken)
    counts = [df.count() for df in outputs[:-1]]
    assert 1000 > counts[0] > counts[1] > counts[2] > counts[3] > 500


def test_packing_holds_what_mixing_kept(outputs):
    assert outputs[4].select("doc_id").distinct().count() == outputs[3].count()


def test_run(spark, outputs):
    assert corpus_pipeline.run(spark, SF).count() == outputs[-1].count()


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_odd_tables(spark, tmp_path, table):
    """Null and empty texts, very long ones, repeated rows, null ids, no row at all: every stage takes what the one before it left."""
    docs = spark.createDataFrame(ODD if table == "odd" else [], DOC)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.columns[0] == "doc_id" and (table == "odd" or docs.count() == 0)


def test_which_odd_documents_survive(spark, tmp_path):
    """Without labels both classifiers keep all; of copies, of repeated rows and of texts without a word one stays; then what mixing takes is packed whole."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, left = spark.createDataFrame(ODD, DOC), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        left[name] = sorted((r["doc_id"] for r in docs.select("doc_id").collect()), key=str)
    every = sorted((r[0] for r in ODD), key=str)
    assert left["quality"] == left["toxicity"] == every
    assert left["dedup"] == sorted([1, 4, 5, 6, 7, 8, None], key=str)
    kept = spark.read.parquet(str(tmp_path / "dedup"))
    taken = mixing.mix(kept, TARGETS, corpus_pipeline.BUDGET_PERCENT, 1).filter("copies > 0")
    assert left["mixing"] == sorted((r["doc_id"] for r in taken.collect()), key=str)
    pieces = docs.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r["doc_id"] for r in pieces} == set(left["mixing"]) and all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces) and before.count() == len(left["mixing"])
