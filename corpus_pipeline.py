"""From raw documents to packed training sequences: five stages, each an operator of ``siftmill.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftmill.llm.common import staged, table
from siftmill.llm.exact_dedup import without_copies
from siftmill.llm.minhash import without_near_copies
from siftmill.llm.mixing import mixed_documents
from siftmill.llm.packing import pack_documents
from siftmill.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, at five-word shingles and a similarity of 0.8."""
    return without_near_copies(docs, num=80, den=100, width=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, repeated or cut, that bring each source to its target."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]
#: The classifier's scores can't be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
