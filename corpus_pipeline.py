"""A corpus pipeline of the operators in quadrat.llm; each stage is written as Parquet and read again.

What all stages do with odd rows: a null text is an empty one; an empty or blank text, or one of any
length, is judged like any other; rows that repeat each other are judged one by one, and near-dedup keeps
one of them; ties go to the least doc_id; a null doc_id takes part, but gives no label; columns beside
doc_id and text are carried along, whatever their names; an empty table gives an empty table of the same
columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadrat.llm import near_dedup, packing, quality_classifier, quality_rules, secrets
from quadrat.llm.common import drop_scratch, materialize, scratch_path, table
from quadrat.session import ship


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no learned rule rejects.

    Without labels of both kinds nothing is learned, and all documents stay; empty texts break no rule by
    being empty, and stay unless a learned rule says otherwise.
    """
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled documents of the whole table.

    The stage before has taken most documents of low quality away, so what is left of them would teach
    it little.  All texts without a word have one score and stay or go together.  An empty table of labels
    gives all texts one score above the threshold.
    """
    labels = quality_classifier.train_rows(table(spark, sf_dir, "labels"))
    model = quality_classifier.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return quality_classifier.keep_above(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more.

    It is that of the least doc_id; of rows that repeat it with the same text, one.  Texts without a word
    are near nothing and stay.
    """
    ship(spark)  # no stage relies on one before it in the same application
    return near_dedup.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; null texts stay null."""
    ship(spark)
    return secrets.redact(docs, secrets.Ledger(spark, scratch_path(spark, "ledger")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens.

    A document without a text is a piece of the end id alone; repeated rows are packed one by one.
    """
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("near dedup", near_dedup_stage),
    ("secret scan", secrets_stage),
    ("packing", packing_stage),
]

#: No SQL: the learned stages can't be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last is not None:
            drop_scratch(last)
        last = docs
    return docs
