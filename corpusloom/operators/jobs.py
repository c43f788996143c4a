"""Batch jobs put together from the operators: a crawl cycle, an OCR cycle, an audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import pages, scoring
from corpusloom.sources import objects

from . import audit, queueing


@dataclass
class CrawlCycle:
    """What a cycle gives: the queue after it, context objects, OCR queue rows, new URLs, audit rows, a summary."""

    queue: DataFrame
    contexts: DataFrame
    ocr_queue: DataFrame
    new_urls: DataFrame
    audit_log: DataFrame
    summary: DataFrame


def discovered(contexts: DataFrame, above: float = 0.5, urgent: float = 0.8) -> DataFrame:
    """Relevant internal links of contexts with their score and priority."""
    links = contexts.select(F.explode("content.links.internal").alias("url"))
    scored = links.withColumn("score", scoring.link_relevance(F.col("url"), F.lit(""))).where(F.col("score") > above)
    return scored.dropDuplicates(["url"]).withColumn("priority", F.when(F.col("score") > urgent, "high").otherwise("medium"))


def ocr_entries(contexts: DataFrame, now: Column, most: int = 5) -> DataFrame:
    """Queue rows for the PDFs, at most ``most`` a page, that are to be fetched and read."""
    wanted = F.filter(F.slice("assets.pdf_links", 1, most), lambda x: x["needs_download"] & x["needs_ocr"])
    rows = contexts.select(F.col("id").alias("context_id"), F.explode(wanted).alias("a"))
    path = pages.storage_path(F.lit("pdf"), F.col("context_id"), F.col("a.url"))
    return rows.select(
        F.sha2(F.concat_ws("|", "context_id", "a.url"), 256).alias("id"), path.alias("storage_path"), "context_id", F.lit("pdf").alias("asset_type"),
        F.col("a.priority").alias("priority"), F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(3).alias("max_attempts"), now.alias("created_at"),
    )


def summary(outcomes: DataFrame) -> DataFrame:
    """One row: processed, successful, failed."""
    return outcomes.agg(F.count(F.lit(1)).alias("processed"), F.count_if("success").alias("successful"), F.count_if(~F.col("success")).alias("failed"))


def ocr_counts(read: DataFrame) -> DataFrame:
    """One row for an OCR batch: processed, successful, failed; a row with an error failed."""
    return summary(read.select(F.col("error").isNull().alias("success")))


def crawl_cycle(queue: DataFrame, fetched: DataFrame, now: Column, limit: int = 10, domain: str | None = None) -> CrawlCycle:
    """Claims the next URLs and applies what was fetched for them (url, html; null html is a failed fetch)."""
    chosen = queueing.next_urls(queue, now, limit, domain)
    got = chosen.select("id", "url").join(fetched.select("url", "html"), "url", "left")
    got = got.withColumn("context_id", F.sha2(F.concat_ws("|", "id", "url"), 256))
    success = F.col("html").isNotNull()
    outcomes = got.select("id", success.alias("success"), F.when(~success, "fetch failed").alias("error"), F.when(success, F.col("context_id")).alias("context_id"))
    built = got.where(success).select(F.col("context_id").alias("id"), "url", pages.context_object(F.col("url"), F.col("html")).alias("c")).select("id", "url", "c.content", "c.provenance")
    contexts = built.withColumn("assets", pages.segregate(F.col("content.links.internal"), F.col("content.media.images")))
    after = queueing.transition(queueing.claim(queue, chosen.select("id"), now), outcomes, now)
    log = outcomes.join(got.select("id", "url"), "id").select(F.lit("crawl_completed").alias("event_type"), F.col("context_id").alias("document_id"), "url", "success", now.alias("timestamp"))
    return CrawlCycle(after, contexts, ocr_entries(contexts, now), discovered(contexts), log, summary(outcomes))


def ocr_cycle(queue: DataFrame, stored: DataFrame, backend: Callable[[str, bytes], str], now: Column, limit: int = 5) -> tuple[DataFrame, DataFrame]:
    """The OCR queue after a batch, and the texts read."""
    read = objects.ocr(queueing.pending_ocr(queue, limit), stored, backend)
    outcomes = read.select("id", F.col("error").isNull().alias("success"), "error", "context_id")
    return queueing.ocr_transition(queue, outcomes, now), read.where("error is null")


def bias_audit(docs: DataFrame, qa_total: int, date: str) -> tuple[DataFrame, str]:
    """The snapshot row and the report of an audit."""
    counts = audit.distributions(docs)
    found = audit.alerts(counts, audit.thresholds(docs.sparkSession))
    return audit.snapshot(counts, qa_total, date), audit.markdown(counts, found, qa_total, date)
