"""Stages for a corpus: rules, toxicity, near duplicates, decontamination, packing.

Every stage takes the documents that its predecessor kept and returns those it
keeps, with the columns of ``documents``; the last returns packed pieces. An
empty input gives an empty output. Rows are judged one by one, also where a
doc_id, a text or a whole row is repeated or null; further columns pass through
all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import decontamination, jaccard, packing, quality_rules, toxicity
from readloom.llm.common import staged, table


def whole_rows(docs: DataFrame) -> DataFrame:
    """The text beside the whole row, so that what a stage adds replaces no column of the documents."""
    return docs.select(F.struct("*").alias("row"), "text")


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    rules = quality_rules.fit_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.judge(whole_rows(docs), rules).where("kept").select("row.*")


def by_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict to be toxic."""
    model = toxicity.fit_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(whole_rows(docs), model).where("predicted = 0").select("row.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links of 5-word Jaccard 0.8 connect: that of least doc_id, null ids last."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_of(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", by_quality_rules),
    ("toxicity", by_toxicity),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The rules and the classifier are learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
