"""Cleaning, personal data, sentences and numbers of a text."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import SPELLINGS
from .textkit import WORD_CHAR, each, let, strip, whole

_B, _E = f"(?<!{WORD_CHAR})", f"(?!{WORD_CHAR})"
_LETTER = "[A-Za-z]"
#: What each kind of personal data looks like, in the order of detection.
PHONES = (
    f"{_B}0\\d{{9}}{_E}", f"(?<={WORD_CHAR})\\+94\\s?\\d{{9}}{_E}", f"{_B}\\d{{3}}[-.\\s]?\\d{{3}}[-.\\s]?\\d{{4}}{_E}", f"{_B}\\d{{10}}{_E}",
)
# after a leading mark of the class the word edge flips, so both forms are there
EMAIL = f"(?:{_B}(?=[A-Za-z0-9_])|(?<={WORD_CHAR})(?=[.%+-]))[%+.0-9A-Z_a-z-]+@[.0-9A-Za-z-]+\\.(?:[A-Z|a-z]{{2,}}(?<=\\|)(?={WORD_CHAR})|[A-Z|a-z]{{2,}}(?<=[A-Za-z]){_E})"
NICS = (f"{_B}\\d{{9}}[VXvx]{_E}", f"{_B}\\d{{12}}{_E}")
KINDS = tuple(("PHONE", p) for p in PHONES) + (("EMAIL", EMAIL),) + tuple(("NIC", p) for p in NICS)


def _composed(texts: pa.Array) -> pa.Array:
    return each(lambda t: None if t is None else unicodedata.normalize("NFC", t), pa.string(), texts)


def compose(text: Column) -> Column:
    """Canonical composition; the one step that no built-in expression has.

    ASCII is composed already. An Arrow function is run for all rows, whatever branch it stands in, so other texts alone are given to it.
    """
    return F.coalesce(F.arrow_udf(_composed, "string")(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def clean(text: Column, composed: bool = True) -> Column:
    """Control characters but newlines deleted, blanks and empty lines reduced, lines stripped."""
    t = F.coalesce(compose(text) if composed else text, F.lit(""))
    t = F.regexp_replace(t, r"[\p{C}&&[^\n]]", "")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    lines = F.transform(F.split(t, "\n", -1), strip)
    return strip(F.array_join(lines, "\n"))


def normalize_spelling(text: Column, spellings: dict[str, str] = SPELLINGS) -> Column:
    """Lower case, and known misspellings of whole words corrected."""

    def corrected(lower: Column) -> Column:
        t = lower
        for wrong, right in spellings.items():
            t = F.regexp_replace(t, whole(wrong), right)
        # the plain look-up rules nearly all texts out; a correction may make another one's word
        return F.when(reduce(or_, (F.contains(lower, F.lit(x)) for x in spellings)), t).otherwise(lower) if spellings else lower

    return let(F.lower(text), corrected)


_FOUND = "array<struct<start:int,ord:int,end:int,kind:string,text:string>>"
_MATCH = pa.list_(pa.struct([("start", pa.int32()), ("ord", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("text", pa.string())]))
_PRIVATE = pa.struct([("masked", pa.string()), ("pii", _MATCH)])
_MARK = re.compile(r"[\d@]")
_COMPILED = [re.compile(p.replace(WORD_CHAR, r"\w")) for _, p in KINDS]


def matches(text: str) -> list[tuple[int, int, int, str, str]]:
    """(start, number of the pattern, end, kind, text) of all matches of all patterns, by start, then by pattern."""
    found = []
    if not _MARK.search(text):  # every pattern has one of these in it
        return found
    for i, ((kind, _), pattern) in enumerate(zip(KINDS, _COMPILED)):
        if kind == "EMAIL":  # only runs with the sign are looked at, with the letter that follows them
            runs = [m for at in _mail_runs(text) for m in pattern.finditer(text, at[0], min(len(text), at[1] + 1))]
        else:
            runs = pattern.finditer(text)
        found += [(m.start(), i, m.end(), kind, m[0]) for m in runs]
    return sorted(found)


def _mail_runs(text: str) -> list[tuple[int, int]]:
    found, at = [], 0
    while (sign := text.find("@", at)) >= 0:
        first = sign
        while first > at and text[first - 1] in _MAIL:
            first -= 1
        last = sign + 1
        while last < len(text) and text[last] in _MAIL:
            last += 1
        found.append((first, last))
        at = last
    return found


_MAIL = frozenset("%+.0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz@|-")


def masked(text: str, found: list[tuple], mask_string: str = "[REDACTED]") -> str:
    """The text with the spans replaced from the last to the first, each at its original offsets.

    What is behind the last replaced start is a stack of pieces; an overlapping span cuts into it as the
    offsets say, so the work grows with the text and not with the text times the spans.
    """
    tail: list[str] = []  # pieces after ``at``, the first one last
    at = len(text)
    for start, _, end, *_ in reversed(found):
        if end <= at:
            tail.append(text[end:at])
        else:
            over = end - at
            while over and tail:
                piece = tail.pop()
                if len(piece) > over:
                    tail.append(piece[over:])
                over = max(0, over - len(piece))
        tail.append(mask_string)
        at = start
    return text[:at] + "".join(reversed(tail))


def _private(text: Column, mask_string: str = "[REDACTED]") -> Column:
    """struct<masked, pii> of a text, in one pass for each pattern."""

    def of(t: str | None) -> dict | None:
        found = matches(t or "")
        return None if t is None else {"masked": masked(t, found, mask_string), "pii": _rows(found)}

    @F.arrow_udf(f"struct<masked:string,pii:{_FOUND}>")
    def run(texts: pa.Array) -> pa.Array:
        return each(of, _PRIVATE, texts)

    return run(text)


def _rows(found: list[tuple]) -> list[dict]:
    return [dict(zip(("start", "ord", "end", "kind", "text"), m)) for m in found]


def _personal(texts: pa.Array) -> pa.Array:
    return each(lambda t: None if t is None else _rows(matches(t)), _MATCH, texts)


def personal_data(text: Column) -> Column:
    """array<struct<start,ord,end,kind,text>> of all matches of all patterns, by start, then by pattern.

    Every pattern has a digit or an @ in it, and Python is given texts that have one (digits beyond ASCII count).
    """
    marked = F.when(F.contains(text, F.lit("@")) | text.rlike("[0-9]") | text.rlike(r"[^\x00-\x7F]"), text)
    return F.when(text.isNotNull(), F.coalesce(F.arrow_udf(_personal, _FOUND)(marked), F.expr(f"cast(array() as {_FOUND})")))


ENDS = {"sinhala": ".!?។", "tamil": ".!?।"}


def sentences(text: Column, language: Column | str = "english") -> Column:
    """Sentences with their end mark, stripped; a mark that follows a mark is a sentence of its own."""
    lang = F.lit(language) if isinstance(language, str) else language

    def cut(marks: str) -> Column:
        parts = F.split(F.regexp_replace(text, f"([{marks}])", "$1\u0001"), "\u0001", -1)
        return F.filter(F.transform(parts, strip), lambda s: F.length(s) > 0)

    return F.when(lang == "sinhala", cut(ENDS["sinhala"])).when(lang == "tamil", cut(ENDS["tamil"])).otherwise(cut(".!?"))


def preprocess(text: Column, language: Column | str = "english", normalize: bool = True, remove: bool = True, mask_string: str = "[REDACTED]") -> Column:
    """struct<cleaned, pii, pii_removed, sentences>."""
    t = normalize_spelling(clean(text)) if normalize else clean(text)
    private = _private(t, mask_string)
    cleaned, found = private["masked"] if remove else t, private["pii"]
    removed = (F.size(found) > 0) if remove else F.lit(False)
    return F.struct(cleaned.alias("cleaned"), found.alias("pii"), removed.alias("pii_removed"), sentences(cleaned, language).alias("sentences"))


TEMPERATURE = r"\d\d\d?(?:[.]\d)?°?[CF°]?"
CLOCK = r"\d\d?(?::\d\d)?\s*(?:pm|PM|am|AM)?"


def health_numbers(text: Column) -> Column:
    """struct<temperatures, times> of number-like matches; both patterns are permissive."""
    found = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0))
    none = F.expr("cast(array() as array<string>)")
    return F.struct(found(TEMPERATURE).alias("temperatures"), none.alias("phone_numbers"), found(CLOCK).alias("times"), none.alias("dates"))
