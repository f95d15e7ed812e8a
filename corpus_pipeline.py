"""A training-data pipeline over documents: each stage is one operator whose decisions take effect.

Toxic documents go; of each class of near duplicates one document stays; passages of the benchmark are cut out; personal
data is replaced; the texts that are left are encoded and decoded. Every stage but the last returns the columns of its
documents. A stage's result is written to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderwell.llm import byte_bpe, decontaminate, near_duplicates, pii, toxicity
from orderwell.llm.common import read
from orderwell.session import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_benchmark(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.production(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("byte_bpe", encoded),
]

#: No SQL expresses the trained classifier or the search for near duplicates; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
