"""Script shares and language of a text, from code-point ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textkit import let, strip

SKIPPED = r"""(?U)[\s\x1c-\x1f.,!?;:()\[\]{}"'\-]"""
RANGES = {"sinhala": r"\x{0D80}-\x{0DFF}", "tamil": r"\x{0B80}-\x{0BFF}", "latin": r"A-z\x{00C0}-\x{024F}"}
DOMINANT, NOTICEABLE, SHORTEST = 0.7, 0.2, 3


def script_counts(text: Column) -> Column:
    """struct<total, sinhala, tamil, latin> of counted characters; white space and common marks don't count."""

    def counts(counted: Column) -> Column:
        each = [F.length(F.regexp_replace(counted, f"[^{r}]+", "")).alias(n) for n, r in RANGES.items()]
        return F.struct(F.length(counted).alias("total"), *each)

    return let(F.regexp_replace(F.coalesce(text, F.lit("")), SKIPPED + "+", ""), counts)


def script_shares(text: Column) -> Column:
    """struct<sinhala, tamil, latin, other> of shares of the counted characters; null where none count."""

    def shares(c: Column) -> Column:
        other = c["total"] - c["sinhala"] - c["tamil"] - c["latin"]
        fields = [(c[n] / c["total"]).alias(n) for n in RANGES] + [(other / c["total"]).alias("other")]
        return F.when(c["total"] > 0, F.struct(*fields))

    return let(script_counts(text), shares)


def script_of(shares: Column) -> Column:
    """sinhala_script, tamil_script, latin, mixed or unknown."""
    top = F.greatest(*(shares[n] for n in (*RANGES, "other")))
    noticeable = sum((F.when(shares[n] >= NOTICEABLE, 1).otherwise(0) for n in (*RANGES, "other")), F.lit(0))
    named = F.when(shares["sinhala"] == top, "sinhala_script").when(shares["tamil"] == top, "tamil_script").when(shares["latin"] == top, "latin")
    return (
        F.when(shares.isNull(), "unknown")
        .when((top >= DOMINANT) & named.isNotNull(), named)
        .when(noticeable >= 2, "mixed")
        .otherwise("unknown")
    )


def detect(text: Column) -> Column:
    """struct<language, confidence, script_type, shares, is_mixed_script, dominant_script>.

    Latin text is English here, whatever language it is in; its confidence is its share.
    """
    short = text.isNull() | (F.length(strip(text)) < SHORTEST)
    return let(F.when(~short, script_shares(text)), lambda shares: let(script_of(shares), lambda script: _detected(shares, script)))


def _detected(shares: Column, script: Column) -> Column:
    best = F.greatest(*(shares[n] for n in RANGES))
    mixed_language = F.when(shares["sinhala"] == best, "sinhala").when(shares["tamil"] == best, "tamil").otherwise("mixed")
    language = (
        F.when(script == "sinhala_script", "sinhala").when(script == "tamil_script", "tamil").when(script == "latin", "english")
        .when(script == "mixed", mixed_language).otherwise("unknown")
    )
    confidence = (
        F.when(script == "sinhala_script", shares["sinhala"]).when(script == "tamil_script", shares["tamil"])
        .when(script == "latin", shares["latin"]).when(script == "mixed", best).otherwise(0.0)
    )
    dominant = F.when(script == "mixed", F.when(shares["sinhala"] == best, "sinhala").when(shares["tamil"] == best, "tamil").otherwise("latin"))
    return F.struct(
        language.alias("language"), confidence.alias("confidence"), script.alias("script_type"), shares.alias("shares"),
        (script == "mixed").alias("is_mixed_script"), dominant.alias("dominant_script"),
    )


def contains_script(text: Column, script: str) -> Column:
    return F.coalesce(text.rlike(f"[{RANGES[script]}]"), F.lit(False))


def is_native(text: Column) -> Column:
    """Whether more than a tenth of the counted characters is Sinhala or Tamil."""
    return F.coalesce(let(script_shares(text), lambda s: (s["sinhala"] > 0.1) | (s["tamil"] > 0.1)), F.lit(False))


def extract_script(text: Column, script: str) -> Column:
    """White space and the script's characters, stripped."""
    return strip(F.regexp_replace(text, rf"(?U)[^\s\x1c-\x1f{RANGES[script]}]", ""))
