"""A training corpus from raw documents: quality, near duplicates, personal data, mix, pieces.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the
columns of the table documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import mixing, pii, quality, simhash, tokens
from tabulon.llm.common import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good ones keeps."""
    return quality.sample(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their new length."""
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to their targets: documents as often as they are taken, the last of a source cut."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, ids and score of the best segmentation, and what the second best loses."""
    done = tokens.encode(docs.select("doc_id", "lang", "source", "text"), best=2)
    best, second = F.get("segmentations", F.lit(0)), F.get("segmentations", F.lit(1))
    return done.select(
        "doc_id", "lang", "source",
        F.size(best["ids"]).alias("n_pieces"), best["ids"].alias("ids"), best["score"].alias("score"),
        (best["score"] - second["score"]).alias("second_loses"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("pieces", encode),
]

#: SQL has neither the models nor the hashes of the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
