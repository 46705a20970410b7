"""The text operators' queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from . import ann, language, licences, mixing, pii, quality, simhash, tokens, urls, video
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op5_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return video.digests(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language.predict(rows, model, ["doc_id", "held_out"])


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document of its number: bad if of low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    outcomes = pages.select("page_id", urls.host_of(F.col("url")).alias("host")).join(bad, "page_id")
    return urls.judge(pages, outcomes.select("host", "bad"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_ann": op2_ann,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_video": op5_video,
    "op6_mixing": op6_mixing,
    "op7_licences": op7_licences,
    "op8_language": op8_language,
    "op9_urls": op9_urls,
    "op10_tokens": op10_tokens,
}

ORACLE_SQL: dict[str, str] = {"op6_mixing": mixing.SQL, "op7_licences": licences.SQL, "op9_urls": urls.SQL}
