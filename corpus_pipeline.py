"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir). All but the last return the
columns of ``documents``. :func:`run` writes each stage's result as Parquet in the shared checkpoint
folder and reads it again, so a lost executor costs a stage's tasks at most.

Defined results for odd rows are those of the operators: null texts count as empty and are kept by the
first three stages, the mix takes no document without words, and an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, common, mixing, simhash, suffix, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a string of 100 bytes that starts earlier go; ``n_chars`` follows the text."""
    cut = suffix.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the sources' target weights takes it."""
    return mixing.take(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("suffix", suffix_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Fingerprints, learned scores and tokens aren't for SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def _folder(spark: SparkSession) -> str:
    """A new folder below the shared one that the cluster names."""
    return f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
