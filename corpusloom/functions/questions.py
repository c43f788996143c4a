"""Question-answer pairs from FAQ text and from entities."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .textkit import let, strip

PAIR = "array<struct<question:string,answer:string,intent:string,domain:string,confidence:double>>"
_PAIRS = pa.list_(pa.struct([("question", pa.string()), ("answer", pa.string()), ("intent", pa.string()), ("domain", pa.string()), ("confidence", pa.float64())]))
_I = re.IGNORECASE


class Form:
    """A way to write a question and its answer: how it opens, what stands between the two, where it ends.

    A pair runs from an opening over the first bridge to the first end. Bridges and ends are found once, so
    openings that lead nowhere cost nothing, however many there are.
    """

    def __init__(self, opening: str, lead: str, bridge: str, answer: str, end: str):
        self.opening, self.bridge, self.end = (re.compile(x, _I) for x in (opening, bridge, end))
        self.lead, self.answer = re.compile(lead, _I), re.compile(answer, _I)

    def pairs(self, text: str) -> Iterator[tuple[str, str]]:
        bridges = [m.span() for m in self.bridge.finditer(text)]
        if not bridges:
            return
        starts = [b[0] for b in bridges]
        ends = [m.start() for m in self.end.finditer(text)]
        stops = {m.start(): m.end() for m in self.end.finditer(text)}
        at = 0
        while (opened := self.opening.search(text, at)) is not None:
            k = bisect_left(starts, opened.end() + 1)
            if k == len(bridges):
                return
            first, last = bridges[k]
            j = bisect_left(ends, last + 1)
            if j == len(ends):
                return
            yield self._without(self.lead, text[opened.end() : first]), self._without(self.answer, text[last : ends[j]])
            at = max(stops[ends[j]], ends[j])

    @staticmethod
    def _without(lead: re.Pattern, part: str) -> str:
        m = lead.match(part)
        return part[m.end() :] if m and m.end() < len(part) else part


FORMS = (
    Form(r"<(?:b|strong|h\d)[^>]*>", r"\s*Q[.:]\s*", r"</(?:b|strong|h\d)>\s*<(?:div|p)[^>]*>", r"\s*A[.:]\s*", r"</(?:div|p)>"),
    Form(r"(?:Question|Q)[.:]\s*", r"(?!)", r"[\r\n]+(?:Answer|A)[.:]\s*", r"(?!)", r"\n\n|\Z"),
)
_NUMBER, _ASKED, _NEXT = re.compile(r"\d+[).]\s*"), re.compile(r"[?]\s*[\r\n]\s*"), re.compile(r"\Z|\n\n|\d+[).]")


def _numbered(text: str) -> Iterator[tuple[str, str]]:
    """A question after a number runs to the last question mark before a line end, its answer to the next number or blank line."""
    at = 0
    asked = [m for m in _ASKED.finditer(text)]
    while asked and (opened := _NUMBER.search(text, at)) is not None:
        mark = asked.pop()
        # of the white space behind the mark, all up to its last line end belongs to the bridge
        begin = mark.start() + 1 + max(mark[0].rfind("\n"), mark[0].rfind("\r"))
        if mark.start() <= opened.end():
            return
        if begin >= len(text):
            if "\n" in mark[0][:-1] or "\r" in mark[0][:-1]:
                return  # a pair with a blank answer
            continue
        end = _NEXT.search(text, begin + 1)
        yield text[opened.end() : mark.start() + 1], text[begin : end.start()]
        return


def faq_of(text: str) -> list[dict]:
    found = []
    for pairs in (*(form.pairs(text) for form in FORMS), _numbered(text)):
        for question, answer in pairs:
            question, answer = plain_of(question), plain_of(answer)
            if len(question) > 10 and len(answer) > 10:
                found.append({"question": question, "answer": answer, "intent": None, "domain": None, "confidence": 0.8})
    return found


def plain_of(text: str) -> str:
    """Without tags, white space collapsed, stripped."""
    parts, at = [], 0
    while (opened := text.find("<", at)) >= 0 and (closed := text.find(">", opened + 2)) >= 0:
        parts.append(text[at:opened])
        at = closed + 1
    return " ".join("".join([*parts, text[at:]]).split())


def plain(text: Column) -> Column:
    """Without tags, white space collapsed, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", ""), r"(?U)[\s\x1c-\x1f]+", " "))


def _pair(question: Column, answer: Column, intent: str | None, domain: Column | None, confidence: float) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(question.alias("question"), answer.alias("answer"), (F.lit(intent) if intent else none).alias("intent"), (none if domain is None else domain).alias("domain"), F.lit(confidence).alias("confidence"))


def _faq(texts: pa.Array) -> pa.Array:
    return pa.array([faq_of(t) for t in texts.to_pylist()], _PAIRS)


def from_faq(text: Column) -> Column:
    """Pairs whose cleaned question and answer both have more than 10 characters, of the whole text."""
    return F.arrow_udf(_faq, PAIR)(F.coalesce(text, F.lit("")))


def answer_in(context: Column, name: Column) -> Column:
    """The first sentence of more than 20 characters that has the name in it, with a full stop."""
    fits = lambda s: F.contains(F.lower(s), F.lower(name)) & (F.length(strip(s)) > 20)
    return F.concat(strip(F.get(F.filter(F.split(context, "[.!?]", -1), fits), F.lit(0))), F.lit("."))


def from_entities(entities: Column, context: Column) -> Column:
    """Questions about hospitals and clinics (place, hours) and diseases (symptoms) that the context answers."""
    return let(entities, lambda entities: let(context, lambda context: _from_entities(entities, context)))


def _from_entities(entities: Column, context: Column) -> Column:
    named = lambda e: F.coalesce(F.nullif(e["normalized"], F.lit("")), e["text"])

    def pairs(e: Column, answer: Column) -> Column:
        place = F.array(
            _pair(F.concat(F.lit("Where is the "), named(e), F.lit("?")), answer, "asking_location", None, 0.6),
            _pair(F.concat(F.lit("What are the opening hours of "), named(e), F.lit("?")), answer, "asking_time", None, 0.6),
        )
        illness = F.array(_pair(F.concat(F.lit("What are the symptoms of "), named(e), F.lit("?")), answer, "asking_symptoms", F.lower(e["text"]), 0.6))
        none = F.expr(f"cast(array() as {PAIR})")
        return F.when(answer.isNull() | (F.length(e["text"]) == 0), none).when(e["type"].isin("hospital", "clinic"), place.cast(PAIR)).when(e["type"] == "disease", illness.cast(PAIR)).otherwise(none)

    # each text that the entities have is looked up once; there are as many as names and spellings
    asked = F.array_distinct(F.transform(F.filter(entities, lambda e: e["type"].isin("hospital", "clinic", "disease")), lambda e: e["text"]))
    answers = F.map_from_entries(F.transform(asked, lambda t: F.struct(t, answer_in(context, t))))
    return let(answers, lambda known: F.flatten(F.transform(entities, lambda e: pairs(e, F.element_at(known, e["text"])))))


def first_of_each(pairs: Column) -> Column:
    """The first pair of each question, compared stripped and in lower case."""
    key = lambda p: F.lower(strip(p["question"]))
    first = lambda pairs, keys: F.transform(F.array_distinct(keys), lambda k: F.get(pairs, (F.array_position(keys, k) - 1).cast("int")))
    return let(pairs, lambda pairs: let(F.transform(pairs, key), lambda keys: first(pairs, keys)))


def from_content(text: Column, entities: Column) -> Column:
    return first_of_each(F.concat(from_faq(text), from_entities(entities, text)))
