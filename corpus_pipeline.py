"""Documents to packed training sequences, in five stages, each written as Parquet and read again.

Toxicity rejects documents; exact copies go, then near copies, one of each group stays; sources are mixed to their target
weights, by which a document may stay away or come up to three times; best-fit packing lays out token sequences. Every
stage works on all its predecessor kept. What a stage does with nulls, empty texts, repeated rows and empty tables is
told by its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.storage import stored
from tradewind.llm import exact, mixing, neardup, packing, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labels of the corpus; a document whose score is 0.3 or more goes."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, names=("_toxicity", "_toxic"))  # columns of documents may have the plain names
    return scored.where("_toxic = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Training a model, seeded hashes and a tokenizer are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
