"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept; all but the last return them with their own columns. Null and empty texts are documents
like others, very long ones are read as a whole, rows that repeat a document are judged alike, and an empty table stays empty; columns with clashing
names pass through. What becomes of each case is stated at the stage.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import common, mixing, packing, quality, simhash, toxicity
from tidewright.llm.queries import TARGETS

#: Share of the tokens that mixing keeps, each at most once.
BUDGET_PERCENT = 90
#: Words whose tokens a worker keeps in packing: fewer than the operator's own, as its workers have all stages' code loaded.
REMEMBER = 120_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. A null or empty text is scored as one without any byte; repeated rows stay or go together; without labels all stay."""
    return quality.keep_good(docs, common.read(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go. A null or empty text isn't toxic; one offending sentence of a very long text is enough; without labels all stay."""
    return toxicity.keep_clean(docs, common.read(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (SimHash covering, then MinHash for what lies beyond its bits; word 5-grams, similarity 0.8 or more) the document with the least doc_id stays, once if its row is repeated.

    Null and empty texts are one group; a null doc_id counts as larger than any other.
    """
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought towards their target weights; a source over its budget keeps a seeded prefix. Texts without a word cost nothing and stay as often as whole epochs."""
    return mixing.take(docs, TARGETS, budget_percent=BUDGET_PERCENT, max_epochs=1, seed=42)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in its sequence. A null or empty text is its end token alone; a very long one goes over several sequences."""
    return packing.pack_documents(docs, remember=REMEMBER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained classifiers and tokenizers can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents table. Each result is written as Parquet in the shared folder and read again.

    A stage's input is deleted once its own result is written; that of the last stage stays, as the returned table reads it.
    """
    docs = common.read(spark, sf_dir, "documents")
    base = f"{common.shared_folder(spark)}/pipeline-{uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if i:
            common.removed(spark, f"{base}/{STAGES[i - 1][0]}")
    return docs
