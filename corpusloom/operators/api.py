"""The application's requests as functions over a catalog of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import annotate as annotation
from . import audit, queueing, store


@dataclass
class Catalog:
    """The tables that requests read: documents, Q&A pairs, queue, statistics, versions."""

    raw_ingest: DataFrame
    qa_pairs: DataFrame
    crawl_queue: DataFrame | None = None
    statistics: DataFrame | None = None
    versions: DataFrame | None = None


def qa_pairs(catalog: Catalog, limit: int = 20, language: str | None = None, domain: str | None = None, verified_only: bool = False) -> DataFrame:
    """The newest pairs that fit; filters come before the limit."""
    rows = catalog.qa_pairs
    if language:
        rows = rows.where(F.col("question_language") == language)
    if domain:
        rows = rows.where(F.col("domain") == domain)
    if verified_only:
        rows = rows.where(F.col("verified"))
    return rows.orderBy(F.desc("created_at"), "id").limit(limit)


def review_page(catalog: Catalog, limit: int = 50) -> DataFrame:
    """The unverified ones among the newest: the limit comes first."""
    return qa_pairs(catalog, limit).where(~F.coalesce("verified", F.lit(False)))


def review_cards(rows: DataFrame) -> DataFrame:
    """What the review page shows of each pair."""
    return rows.select(F.substring("id", 1, 8).alias("short_id"), F.substring("question_text", 1, 80).alias("question"), F.coalesce(F.nullif("domain", F.lit("")), F.lit("general")).alias("domain"))


def verify(catalog: Catalog, decisions: DataFrame, now: Column) -> DataFrame:
    return store.verify(catalog.qa_pairs, decisions, now)


def document(catalog: Catalog, id: str) -> DataFrame:
    return catalog.raw_ingest.where(F.col("id") == id).limit(1)


def by_hash(catalog: Catalog, content_hash: str) -> DataFrame:
    return catalog.raw_ingest.where(F.col("content_hash") == content_hash).orderBy("id").limit(1)


def stats(catalog: Catalog) -> DataFrame:
    """One row: documents, pairs, pending URLs."""
    n = F.count(F.lit(1))
    out = catalog.raw_ingest.agg(n.alias("documents")).join(F.broadcast(catalog.qa_pairs.agg(n.alias("qa_pairs"), F.count_if("verified").alias("verified"))))
    if catalog.crawl_queue is not None:
        out = out.join(F.broadcast(catalog.crawl_queue.agg(F.count_if(F.col("status") == "pending").alias("pending"))))
    return out


def system_status(catalog: Catalog, assets: DataFrame, now: Column) -> DataFrame:
    """Queue and asset statistics and the clock, in one row."""
    return queueing.statistics(catalog.crawl_queue).join(F.broadcast(asset_statistics(assets))).withColumn("at", now)


def asset_statistics(assets: DataFrame) -> DataFrame:
    """Rows, PDFs, images and pages that need OCR, of columns pdf, images and ocr_required."""
    return assets.agg(
        F.count(F.lit(1)).alias("total_documents"), F.coalesce(F.sum(F.coalesce("pdf", F.lit(0))), F.lit(0)).alias("pdf_assets"),
        F.coalesce(F.sum(F.coalesce("images", F.lit(0))), F.lit(0)).alias("image_assets"), F.count_if("ocr_required").alias("ocr_required"), F.lit(0).alias("html_pages"),
    )


def annotate_text(spark, text: str, source_url: str | None = None) -> DataFrame:
    return annotation.annotate(spark.createDataFrame([(source_url, text)], "url string, text string"))


def bias_report(catalog: Catalog) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distributions, alerts and gaps."""
    counts = audit.distributions(catalog.raw_ingest)
    found = audit.alerts(counts, audit.thresholds(catalog.raw_ingest.sparkSession))
    return counts, found, audit.gaps(found)


def latest_statistics(catalog: Catalog) -> DataFrame:
    return catalog.statistics.orderBy(F.desc("snapshot_date")).limit(1)


def enqueue(catalog: Catalog, urls: DataFrame, now: Column) -> DataFrame:
    """New queue rows; a given priority is kept elsewhere, the score is that of medium."""
    return queueing.enqueue(catalog.crawl_queue, urls, now, "medium")


def health(spark) -> DataFrame:
    return spark.createDataFrame([("healthy",)], "status string")
