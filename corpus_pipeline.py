"""From raw documents to packed training sequences, one operator a stage.

A stage takes ``(spark, docs, sf_dir)``. ``run`` writes each stage's rows to the shared folder and
gives the next one what was written, so a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm import langid, mixing, packing, quality, simhash
from rowgate.llm import queries as settings
from rowgate.llm.common import fold
from rowgate.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows that Python workers get at a time, unless the session says otherwise: a MB or two of texts. Spark's
#: 10,000 make workers grow by what a batch and its copies hold, and they keep that through all later stages.
BATCH_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: SQL cannot express the first stage (a trained model), nor most of the others.
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """Set the pipeline's batch size for its session, where none is set."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from the rows of the stage outside the held-out fold."""
    small_batches(spark)
    model = langid.train(docs, fold(F.col("doc_id"), 3) != 1)
    return langid.identified(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules pass."""
    small_batches(spark)
    model = settings.quality_model(docs, spark, sf_dir)
    return quality.accepted(docs, model, settings.GOOD)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked."""
    small_batches(spark)
    return simhash.deduplicated(docs, settings.SHINGLE_WORDS, settings.MOST_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.in_order(mixing.mixed(docs, settings.WEIGHTS, settings.REST_UNITS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences, which follow the mix."""
    small_batches(spark)
    return packing.packed_in_order(docs, public_tokenizers.path(settings.TOKENIZER), settings.CAPACITY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("quality", keep_quality),
    ("simhash_near_dedup", remove_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents. What a stage has written goes when the next one has."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        staging = Staging(spark)
        docs = staging.keep(stage(spark, docs, sf_dir), name)
        if before:
            before.clear()
        before = staging
    return docs
