"""From raw documents to packed sequences, stage by stage.

Each stage takes what the one before has kept, reread from Parquet; all but the last return rows
with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import prefdata
from prefdata.llm import jaccard_join, mixing, quality, sos_packing, toxicity
from prefdata.llm.common import store, table

cloudpickle.register_pickle_by_value(prefdata)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality posterior rejects go. Host: source; path: language there."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, F.col("source"), F.col("lang"))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Near-duplicates share 0.8 of their runs of five words; op3's own contract is four words and 0.85.
    """
    return jaccard_join.keep_one(docs, size=5, similarity=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document that is taken twice is there twice."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences; one row per piece."""
    return sos_packing.packed(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("toxicity", clean_documents),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", sequences),
]

# Learned scores, components of links and packings are not SQL; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
