"""Documents to a training mix, stage by stage; each stage is stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.llm import containment, mixing, ngram_join, pii, repetition
from quarterlode.llm.common import prepare, table
from quarterlode.session import materialise

KEY = "demonstration key"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go.

    Null and empty texts have no words and go; each row is judged alone, so repeated rows stay or go together.
    """
    prepare(spark)
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Null ids come last; of rows that repeat each other one stays. Texts without words are in no group and stay.
    """
    prepare(spark)
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item of five words or more go.

    Shorter items stand in many clean documents and are left to the query that reports them. Null and empty texts
    contain nothing; rows with equal texts stay or go together.
    """
    prepare(spark)
    return containment.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced; ``n_chars`` follows the text.

    Null texts stay null, with a null ``n_chars``; equal texts stay equal; no row goes.
    """
    prepare(spark)
    return pii.replace_entities(docs, KEY).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes: its columns, and the number of the copy.

    Null sources are one source, the last. Texts without words are not taken. Each of several equal rows is taken by
    itself, and ties in the queue are settled by key, id and copy.
    """
    prepare(spark)
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("surrogates", surrogates), ("mixing", mixture),
]
# Keyed surrogates cannot be written in SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
