"""The corpus pipeline: stages that turn raw documents into packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseloom.llm import exact_dedup, minhash, packing, secret_scan, toxicity
from pulseloom.llm.catalog import remainder
from pulseloom.llm.vocabulary import vocabulary_path
from pulseloom.plans.bindings import table
from pulseloom.session import materialise, tune

#: Rows and bytes that executors hold at a time for Python, there and back.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}
#: Words that a worker remembers for packing, during one task.
KEPT_WORDS = 400_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def prepare(spark: SparkSession) -> SparkSession:
    """The runtime settings, and bounded batches for Python.

    Each stage sets them, since stages can be run one by one; its rows are read after it has returned.
    """
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return tune(spark)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder(5) != 0))
    return docs.where(toxicity.score(model, F.col("text")) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.survivors(docs, exact_dedup.fresh_index(prepare(spark)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 stays."""
    prepare(spark)
    return minhash.survivors(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported part of a credential gives way to a mark."""
    prepare(spark)
    return secret_scan.redact(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    prepare(spark)
    return packing.pack(packing.pieces(docs, vocabulary_path("word_bpe_49k.json"), kept_words=KEPT_WORDS, lasting=False))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack_tokens),
]

#: A fitted classifier and signatures have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    before = {key: spark.conf.get(key) for key in BATCH_SETTINGS}
    prepare(spark)
    try:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return docs
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
