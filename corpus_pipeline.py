"""A corpus pipeline of five stages over a table of documents.

Every stage works on all that its predecessor kept. A toxic document goes; of each group of near
duplicates the smallest id stays; personal data is replaced by its kind; sources are mixed to their
weights, which drops, repeats and cuts documents; the rest is encoded. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.llm import bpe, mixing, pii, simhash, toxicity
from shelf.llm.common import new_folder, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Rows that go to a Python worker at once: the JVM and the worker each hold a batch of whole texts.
BATCH_ROWS = 1000


def small_batches(stage: Stage) -> Stage:
    """The stage, in whose session batches of rows for Python workers are small from then on."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of this corpus and its labels does not call toxic."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


@small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash finds and a Jaccard similarity of 0.8 on five-word shingles links."""
    return simhash.deduplicate(docs)


@small_batches
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; n_chars follows the new text."""
    hidden = pii.redact_documents(docs)
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources weighted 1, 2, 3, 1, ...: a row per copy or part of a document taken."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text for every row."""
    return bpe.digest_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", hide_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can express none of the learnt stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder; each writes Parquet that the next one reads."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
