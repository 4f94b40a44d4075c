"""The corpus pipeline: five stages over ``documents``, each written and reread.

quality    documents that the classifier rejects go
near_dups  one document of each group of near copies stays
decontam   documents that hold a benchmark item go
pii        personal data in texts is masked
packing    texts become token sequences (the last stage returns pieces)

A stage is ``function(spark, docs, sf_dir) -> DataFrame``; all but the last
return the columns of ``documents``.  Part of ``kinetra.llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.llm import decontam, packing, pii, quality_bt, simhash_trie
from kinetra.llm.queries import table
from kinetra.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_bt.keep_good(docs, table(spark, sf_dir, "labels")).select(docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_trie.keep_one(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masked texts; n_chars becomes the length of the masked text."""
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length("text").cast(kind))
    return masked.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dups", near_dups),
    ("decontam", decontamination),
    ("pii", personal_data),
    ("packing", pack),
]

#: A fitted model, fingerprints and tokenisers are beyond SQL; tests hold the
#: pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
