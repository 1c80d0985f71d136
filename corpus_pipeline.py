"""From raw documents to a training mix, one stage after the other.

Every stage takes all rows that the one before it kept.  Between stages the rows are
written to the shared folder and read again, so each stage starts from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataload.llm.common import prepare, settle
from strataload.llm.decontaminate import without_leaks
from strataload.llm.langid import known_language
from strataload.llm.minhash import NearDupSpec, keep_one
from strataload.llm.mixing import mixed_documents
from strataload.llm.pii import private_text


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that are in no learned language."""
    prepare(spark)
    return known_language(docs)


# At a similarity of 0.8 a pair meets in no band with probability 7e-6.
NEAR = NearDupSpec(percent=80, bands=30, rows=5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five words, similarity of 0.8 or more."""
    prepare(spark)
    return keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item."""
    benchmark = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return without_leaks(docs, benchmark)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    prepare(spark)
    return private_text(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the number of copies and the words they give."""
    prepare(spark)
    return mixed_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pseudonyms", pseudonyms),
    ("mixture", mixture),
]

# The language model, the hashes and the permutations have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs)
    return docs
