"""Crawl and OCR queues as DataFrames: selection, state transitions, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.scoring import host, priority, retry_minutes
from corpusloom.operators.store import one_each

STATES = ("pending", "processing", "completed", "failed")


def due(queue: DataFrame, now: Column, domain: str | None = None) -> DataFrame:
    rows = queue.where((F.col("status") == "pending") & (F.col("scheduled_time") <= now))
    return rows if domain is None else rows.where(F.col("domain") == domain)


def next_urls(queue: DataFrame, now: Column, limit: int, domain: str | None = None) -> DataFrame:
    """The due rows of the highest scores; null scores first, as the store sorts; ties by age, then id."""
    return due(queue, now, domain).orderBy(F.desc_nulls_first("priority_score"), "created_at", "id").limit(limit)


def pending_ocr(queue: DataFrame, limit: int) -> DataFrame:
    return queue.where(F.col("status") == "pending").orderBy("created_at", "id").limit(limit)


def claim(queue: DataFrame, claimed: DataFrame, now: Column) -> DataFrame:
    """The queue with the claimed ids in processing, one attempt more."""
    marked = claimed.select("id").distinct().withColumn("_claimed", F.lit(True))
    hit = F.coalesce("_claimed", F.lit(False))
    joined = queue.join(marked, "id", "left")
    updates = {
        "status": F.when(hit, "processing").otherwise(F.col("status")),
        "attempts": F.when(hit, F.coalesce("attempts", F.lit(0)) + 1).otherwise(F.col("attempts")),
        "processing_started_at": F.when(hit, now).otherwise(F.col("processing_started_at") if "processing_started_at" in queue.columns else F.lit(None).cast("timestamp")),
    }
    return joined.withColumns(updates).drop("_claimed")


def transition(queue: DataFrame, outcomes: DataFrame, now: Column, retry: bool = True) -> DataFrame:
    """The queue after outcomes (id, success, error, context_id).

    A success completes a row. A failure counts one more attempt; below the maximum it goes back to pending
    after 2**attempts minutes, else it has failed. Of several outcomes of a row one counts.
    """
    o = one_each(outcomes.select("id", "success", "error", "context_id")).select("id", F.col("success").alias("_ok"), F.col("error").alias("_error"), F.col("context_id").alias("_context"))
    joined = queue.join(o, "id", "left")
    ok, bad = F.coalesce("_ok", F.lit(False)), F.coalesce(~F.col("_ok"), F.lit(False))
    tried = F.coalesce("attempts", F.lit(0)) + 1
    again = bad & F.lit(retry) & (tried < F.coalesce(F.when(F.col("max_attempts") != 0, F.col("max_attempts")), F.lit(3)))
    keep = lambda c: F.col(c) if c in queue.columns else F.lit(None)
    later = F.timestamp_seconds(F.unix_micros(now) / 1_000_000 + retry_minutes(tried) * 60)
    updates = {
        "status": F.when(ok, "completed").when(again, "pending").when(bad, "failed").otherwise(F.col("status")),
        "scheduled_time": F.when(again, later).otherwise(keep("scheduled_time").cast("timestamp")),
        "completed_at": F.when(ok, now).otherwise(keep("completed_at").cast("timestamp")),
        "context_id": F.when(ok, F.col("_context")).otherwise(keep("context_id").cast("string")),
        "last_error": F.when(bad, F.col("_error")).otherwise(keep("last_error").cast("string")),
        "attempts": F.when(bad, tried).otherwise(F.col("attempts")),
    }
    return joined.withColumns(updates).select(*queue.columns, *[c for c in updates if c not in queue.columns])


def ocr_transition(queue: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Pending or processing rows complete or fail; there is no retry."""
    return transition(queue, outcomes, now, retry=False).drop(*{"scheduled_time"} - set(queue.columns))


def statistics(queue: DataFrame) -> DataFrame:
    """One row: rows in each known state and their sum; other states don't count."""
    each = [F.count_if(F.col("status") == s).alias(s) for s in STATES]
    return queue.agg(*each).withColumn("total", sum((F.col(s) for s in STATES), F.lit(0)))


def without_expired(queue: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Rows that stay: completed ones go after some days; failed ones have no completion time and stay."""
    old = F.col("status").isin("completed", "failed") & (F.col("completed_at") < now - F.make_dt_interval(F.lit(days)))
    return queue.where(~F.coalesce(old, F.lit(False)))


def enqueue(queue: DataFrame, urls: DataFrame, now: Column, level: str = "medium", agency: str = "Unknown") -> DataFrame:
    """New queue rows for URLs (url, reliability, user_demand) that aren't pending yet, one for each URL."""
    waiting = queue.where(F.col("status") == "pending").select("url")
    new = urls.dropDuplicates(["url"]).join(waiting, "url", "left_anti")
    score = priority(F.col("url"), F.lit(level), F.lit(0), F.coalesce("user_demand", F.lit(0.0)), F.col("reliability"))
    return new.select(
        F.sha2("url", 256).alias("id"), "url", host(F.col("url")).alias("domain"), F.lit(agency).alias("source_agency"), F.lit(level).alias("priority"),
        score.alias("priority_score"), F.lit("pending").alias("status"), now.alias("scheduled_time"), now.alias("created_at"), F.lit(0).alias("attempts"),
        F.lit(3).alias("max_attempts"), F.lit(None).cast("string").alias("last_error"),
    )


def enqueue_batch(urls: DataFrame, now: Column, level: str = "medium", agency: str = "Unknown") -> DataFrame:
    """Rows for all URLs of a batch, without looking for pending ones; reliability and demand of the source don't count."""
    plain = urls.select("url", F.lit(None).cast("double").alias("reliability"), F.lit(0.0).alias("user_demand"))
    score = priority(F.col("url"), F.lit(level), F.lit(0), F.lit(0.0))
    return plain.select(
        F.sha2("url", 256).alias("id"), "url", host(F.col("url")).alias("domain"), F.lit(agency).alias("source_agency"), F.lit(level).alias("priority"),
        score.alias("priority_score"), F.lit("pending").alias("status"), now.alias("scheduled_time"), now.alias("created_at"), F.lit(0).alias("attempts"), F.lit(3).alias("max_attempts"),
    )


def start_times(queue: DataFrame, delay: float, domain: str = "domain") -> DataFrame:
    """Earliest start in seconds of each row when a domain is asked every ``delay`` seconds at most."""
    turn = F.row_number().over(Window.partitionBy(domain).orderBy(F.desc("priority_score"), "id"))
    return queue.withColumn("start_after", (turn - 1) * F.lit(delay))


def allowed(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Rows that no rule (site, disallow_prefix) forbids; a site is scheme://host, and one without rules is open."""
    u = F.col(url)
    site = F.concat(F.coalesce(F.try_parse_url(u, F.lit("PROTOCOL")), F.lit("")), F.lit("://"), host(u))
    here = F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit(""))
    r = rules.where(F.length("disallow_prefix") > 0).select(F.col("site").alias("_site"), F.col("disallow_prefix").alias("_prefix"))
    return pages.join(r, (site == F.col("_site")) & F.startswith(here, F.col("_prefix")), "left_anti")


def crawl_due(last: Column, now: Column, hours: float = 12) -> Column:
    return last.isNull() | (F.unix_seconds(now) - F.unix_seconds(last) >= hours * 3600)


def audit_due(last: Column, now: Column) -> Column:
    """On Sundays (UTC), a day after the last audit at the earliest."""
    return (F.weekday(now) == 6) & (last.isNull() | (F.unix_seconds(now) - F.unix_seconds(last) >= 86400))
