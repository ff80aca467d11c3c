"""Documents to training sequences: language, near-duplicates, personal data, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapweave.llm import languages, minhash, mixing, packing, pii
from gapweave.operators.settle import settle

#: Documents whose language is predicted with a score up to this are rejected, as are those without one.
LEAST_SCORE = 0.25


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; the machines are trained on the stage's own input."""
    return languages.keep_identified(docs, languages.train(docs), LEAST_SCORE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.keep_first(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what reveals it replaced."""
    return pii.sanitise(docs, support=1)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target sizes: documents left out, kept, repeated or cut on the border."""
    return mixing.apply_mix(docs)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their ids, each a sequence of its own."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("personal_data", without_personal_data),
    ("mixing", to_weights),
    ("packing", into_sequences),
]

#: Trained models, sketches and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
