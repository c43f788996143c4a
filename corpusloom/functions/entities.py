"""Entities: gazetteer names and patterns for times, dates and phones."""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import GAZETTEER, Name
from .textkit import WORD_CHAR, bounded, let, whole

CATEGORIES = ("hospital", "disease", "symptom", "clinic")
_DAYS = "|".join(d + "day" for d in ("Satur", "Sun", "Mon", "Tues", "Wednes", "Thurs", "Fri"))
PATTERNS = (
    ("time", r"\d\d?:\d\d\s*(?:pm|am)(?!W)|\d\d?:\d\d\s*(?<!W)(?=W)|\d\d?:\d\d(?!W)".replace("W", WORD_CHAR), True),
    ("time", r"\d\d?\s*(?:pm|am)", False),
    ("time", "night|evening|afternoon|morning", False),
    ("date", r"\d{1,2}[-/]\d{1,2}[-/]\d{2,4}", False),
    ("date", _DAYS, False),
    ("date", "(?:weekend|weekday)s?", False),
    ("phone", r"0\d{9}", False),
    ("phone", rf"(?<={WORD_CHAR})\+94\s?\d{{9}}(?!{WORD_CHAR})", True),
)
_ENTITY = "array<struct<start:int,rank:double,ordinal:int,end:int,type:string,text:string,normalized:string,confidence:double,place:string,kind:string>>"
_FIELDS = [("start", pa.int32()), ("rank", pa.float64()), ("ordinal", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("text", pa.string()), ("normalized", pa.string()), ("confidence", pa.float64()), ("place", pa.string()), ("kind", pa.string())]
_COLUMN = pa.list_(pa.struct(_FIELDS))


def compiled(pattern: str, flags: int = 0) -> re.Pattern:
    """A pattern of this package for Python, whose word characters are the same."""
    return re.compile(pattern.replace(WORD_CHAR, r"\w"), flags)


class Finder:
    """All entities of a text in one pass for each known name and pattern, so time grows with the text's length."""

    def __init__(self, names: tuple[Name, ...]):
        self.aliases: list[tuple[str, re.Pattern, str, int, str, Name]] = []
        self.names: list[tuple[str, str, int, str, Name]] = []
        for i, category in enumerate(CATEGORIES):
            rows: dict[str, Name] = {}
            for name in names:
                if name.category == category:
                    rows |= {alias.lower(): name for alias in name.aliases}
                    self.names.append((name.canonical.lower(), name.canonical, 10 * i + 1, category, name))
            self.aliases += [(a, compiled(whole(a)), n.canonical, 10 * i, category, n) for a, n in rows.items()]
        self.patterns: list[tuple[re.Pattern, int, str]] = []
        for i, (kind, body, as_is) in enumerate(PATTERNS):
            pattern = f"(?<!{WORD_CHAR})(?:{body})" if as_is and kind == "time" else body if as_is else bounded(body)
            self.patterns.append((compiled(pattern, 0 if kind == "phone" else re.IGNORECASE), 100 + i, kind))

    def __call__(self, text: str) -> list[dict]:
        lower, found = text.lower(), []
        for alias, pattern, canonical, ordinal, category, name in self.aliases:
            if alias in lower:
                for m in pattern.finditer(lower):
                    found.append((m.start(), -0.9, ordinal, m.end(), category, text[m.start() : m.end()], canonical, name.place, name.kind))
        for low, canonical, ordinal, category, name in self.names:
            if (at := lower.find(low)) >= 0:
                found.append((at, -1.0, ordinal, at + len(low), category, text[at : at + len(low)], canonical, name.place, name.kind))
        for pattern, ordinal, kind in self.patterns:
            for m in pattern.finditer(text):
                found.append((m.start(), -0.95, ordinal, m.end(), kind, m[0], None, "", ""))
        found.sort(key=lambda e: e[:6])
        kept, last = [], -1
        # by start, then the more confident; what starts before the last kept one ends is dropped
        for start, rank, ordinal, end, kind, said, canonical, place, what in found:
            if start >= last:
                last = end
                kept.append({"start": start, "rank": rank, "ordinal": ordinal, "end": end, "type": kind, "text": said, "normalized": canonical, "confidence": -rank, "place": place, "kind": what})
        return kept


@cache
def finder_of(names: tuple[Name, ...]) -> Finder:
    return Finder(names)


def extract(text: Column, names: tuple[Name, ...] = GAZETTEER) -> Column:
    """array<entity> in order of start, without overlaps; a null text has none."""

    @F.arrow_udf(_ENTITY)
    def found(texts: pa.Array) -> pa.Array:
        from corpusloom.functions.entities import finder_of  # by name: the worker's own

        finder = finder_of(names)
        return pa.array([finder(t) for t in texts.to_pylist()], _COLUMN)

    return found(F.coalesce(text, F.lit("")))


def counts(entities: Column) -> Column:
    """map<type, number>."""

    def of(entities: Column) -> Column:
        types = F.array_distinct(F.transform(entities, lambda e: e["type"]))
        return F.map_from_entries(F.transform(types, lambda k: F.struct(k, F.size(F.filter(entities, lambda e: e["type"] == k)))))

    return let(entities, of)


def summary(entities: Column) -> Column:
    """map<type, distinct names> (normalized, else as written), in order of appearance."""

    def of(entities: Column) -> Column:
        types = F.array_distinct(F.transform(entities, lambda e: e["type"]))
        named = lambda k: F.array_distinct(F.transform(F.filter(entities, lambda e: e["type"] == k), lambda e: F.coalesce(e["normalized"], e["text"])))
        return F.map_from_entries(F.transform(types, lambda k: F.struct(k, named(k))))

    return let(entities, of)
