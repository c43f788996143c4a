"""Batch jobs on a small queue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corpusloom.functions import pages
from corpusloom.operators import jobs


def test_crawl_and_ocr_cycles(spark):
    now, when = F.to_timestamp(F.lit("2024-01-02 00:00:00")), dt.datetime(2024, 1, 1)
    rows = [(str(i), f"https://www.health.gov.lk/p{i}", "www.health.gov.lk", i / 10, "pending", when, when, 0, 3) for i in range(4)]
    queue = spark.createDataFrame(rows, "id string, url string, domain string, priority_score double, status string, scheduled_time timestamp, created_at timestamp, attempts int, max_attempts int")
    html = '<h1>T</h1><p>a</p><a href="/clinic-schedule.pdf">x</a><a href="https://www.health.gov.lk/dengue/report.pdf">y</a><img src="i.png"><a href="/">z</a>'
    got = jobs.crawl_cycle(queue, spark.createDataFrame([("https://www.health.gov.lk/p3", html)], "url string, html string"), now, 2)
    assert {r.id: (r.status, r.attempts) for r in got.queue.collect()} == {"3": ("completed", 1), "2": ("pending", 2), "1": ("pending", 0), "0": ("pending", 0)}
    assert got.summary.first().asDict() == {"processed": 2, "successful": 1, "failed": 1} and got.audit_log.count() == 2
    assert sorted(r.url for r in got.new_urls.collect()) == ["/clinic-schedule.pdf", "https://www.health.gov.lk/dengue/report.pdf"]
    entries = got.ocr_queue
    assert sorted(r.storage_path.split("/")[-1] for r in entries.collect()) == ["clinic-schedule.pdf", "report.pdf"]
    stored = entries.where(F.col("storage_path").endswith("report.pdf")).select(F.col("storage_path").alias("path"), F.encode(F.lit("text"), "utf-8").alias("content"))
    after, texts = jobs.ocr_cycle(entries, stored, lambda kind, content: content.decode(), now)
    assert sorted(r.status for r in after.collect()) == ["completed", "failed"] and [r.text for r in texts.collect()] == ["text"]


def test_extraction_and_audit(spark):
    html = '<h2>Head</h2><div class="x content y">body <b>b</b></div><p>par</p><span class="date">May</span><time>June</time>'
    row = spark.range(1).select(pages.extracted(F.lit(html)).alias("e")).first()["e"]
    assert (row["title"], row["content"], row["date"]) == ("Head", "par\nbody b", "May")
    docs = spark.createDataFrame([("english", False, None, "dengue", None)], "detected_language string, is_romanized boolean, romanized_type string, domain string, region string")
    snapshot, report = jobs.bias_audit(docs, 2, "2024-01-01")
    assert snapshot.first().total_documents == 1 and "Bias Alerts" in report
