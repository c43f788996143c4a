"""Content hashes and differences between versions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .textkit import each, strip


def normalized(text: Column) -> Column:
    """Lower case, white space collapsed, then everything but word characters and white space deleted."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[\s\x1c-\x1f]+", " ")
    return strip(F.regexp_replace(t, r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]", ""))


def _token_words(texts: pa.Array) -> pa.Array:
    def of(text: str) -> dict:
        tokens = sorted(set(text.split(" ")) - {""})
        return {"words": " ".join(tokens), "n": len(tokens)}

    return each(of, pa.struct([("words", pa.string()), ("n", pa.int32())]), texts)


def token_words(text: Column) -> Column:
    """struct<words, n>: the sorted distinct tokens of the normalized text, joined by blanks, and their number."""
    return F.arrow_udf(_token_words, "struct<words:string,n:int>")(normalized(text))


def content_hash(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def token_set(text: Column) -> Column:
    """Distinct tokens of the normalized text."""
    return F.array_distinct(F.filter(F.split(normalized(text), " ", -1), lambda w: F.length(w) > 0))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(strip(F.coalesce(text, F.lit(""))), r"(?U)[\s\x1c-\x1f]+", -1), lambda w: F.length(w) > 0))


def diff_summary(old: Column, new: Column) -> Column:
    return delta_summary(word_count(new) - word_count(old))


def delta_summary(delta: Column) -> Column:
    some = lambda verb, n: F.concat(F.lit(f"{verb} ~"), n.cast("string"), F.lit(" words"))
    return F.when(delta > 0, some("Added", delta)).when(delta < 0, some("Removed", -delta)).otherwise("Minor changes (same word count)")
