"""Corpus pipeline: toxic documents go, one document of each near-duplicate group stays, documents with benchmark
passages go, personal data is redacted, and what is left is encoded.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; models are trained on the stage's own input.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import bpe, common, decontaminate, pii, simhash, toxicity
from cardwatch.sources import storage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, only_clean=True).select(*[common.quoted(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest id."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in the text replaced by its kind; ``n_chars`` follows the text."""
    out = pii.redact(docs, pii.train(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the text decoded from them."""
    path = public_tokenizers.path(bpe.VOCABULARY)
    return bpe.encode(docs.select("doc_id", "text", "lang", "source"), path, public_tokenizers.PATTERN).drop("text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("byte_bpe", encode),
]

#: No SQL: the stages train models and merge tokens; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again.

    A stage's rows are deleted once the next one's are written, so the folder holds two copies of the corpus at most and
    in the end what the last stage reads.
    """
    folder = f"{common.shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            storage.delete_folder(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
