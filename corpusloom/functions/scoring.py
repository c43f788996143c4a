"""Priority of URLs, relevance of links, retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import LEVELS, LINK_WORDS, RELIABILITY


def host(url: Column) -> Column:
    """The authority part of a URL, port and case kept; empty where it can't be read."""
    return F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def reliability(url: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(None).cast("double"))
    for part, value in RELIABILITY:
        chain = chain.when(F.contains(host(url), F.lit(part)), value)
    return chain.otherwise(RELIABILITY[-1][1])


def _clamp(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def priority(url: Column, level: Column, freshness_days: Column, demand: Column, given: Column | None = None) -> Column:
    """Score in [0, 1] from level, source reliability, age and demand."""
    base = F.lit(0.5)
    for name, weight in LEVELS.items():
        base = F.when(level == name, weight).otherwise(base)
    trusted = reliability(url) if given is None else F.coalesce(given, reliability(url))
    fresh = F.least(freshness_days / F.lit(30.0), F.lit(1.0)) * 0.3
    return _clamp(base * 0.4 + trusted * 0.3 + fresh + demand * 0.2)


def link_relevance(url: Column, text: Column) -> Column:
    """Score in [0, 1] of a link; sums run in the word list's order, since thresholds are sensitive to it."""
    u, t = F.lower(F.coalesce(url, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    score = F.lit(0.0)
    for word in LINK_WORDS:
        score = score + F.when(F.contains(u, F.lit(word)), 0.15).otherwise(0.0)
        score = score + F.when(F.contains(t, F.lit(word)), 0.10).otherwise(0.0)
    official = F.contains(u, F.lit("gov.lk"))
    score = score + F.when(official, 0.3).otherwise(0.0)
    return _clamp(score - F.when(F.startswith(u, F.lit("http")) & ~official, 0.2).otherwise(0.0))


def retry_minutes(attempts: Column) -> Column:
    return F.pow(F.lit(2), attempts)
