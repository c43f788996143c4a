"""Romanized Sinhala and Tamil in Latin text: classes, scores, markers and code switches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import Markers
from .textkit import ascii_tokens, is_blank, let

ENOUGH = 0.3


def _in(words) -> callable:
    known = sorted(words)
    return lambda w: w.isin(known)


def scores(tokens: Column, markers: Markers = Markers()) -> Column:
    """struct<singlish, tamilish, english>: shares of the tokens that aren't neutral health terms."""

    def of(content: Column) -> Column:
        n = F.size(content)
        share = lambda words: F.when(n > 0, F.size(F.filter(content, _in(words))) / n).otherwise(0.0)
        return F.struct(share(markers.singlish).alias("singlish"), share(markers.tamilish).alias("tamilish"))

    both = let(F.filter(tokens, lambda w: ~w.isin(sorted(markers.neutral))), of)
    return let(both, lambda s: F.struct(s["singlish"].alias("singlish"), s["tamilish"].alias("tamilish"), (1 - F.greatest(s["singlish"], s["tamilish"])).alias("english")))


def matched_markers(tokens: Column, markers: Markers = Markers()) -> Column:
    """The Singlish markers among the content tokens, then the Tamilish ones, repeats kept."""
    content = F.filter(tokens, lambda w: ~w.isin(sorted(markers.neutral)))
    return F.concat(F.filter(content, _in(markers.singlish)), F.filter(content, _in(markers.tamilish)))


def code_switches(text: Column, tokens: Column, markers: Markers = Markers()) -> Column:
    """array<struct<start_pos,end_pos,from_lang,to_lang,text_segment>> where the language of known tokens changes.

    A position is that of the token's first occurrence as a substring of the lower-cased text.
    """
    tag = lambda w: (
        F.when(w.isin(sorted(markers.singlish)), "singlish").when(w.isin(sorted(markers.tamilish)), "tamilish").when(w.isin(sorted(markers.neutral)), "english")
    )
    tagged = F.filter(F.transform(tokens, lambda w: F.struct(w.alias("word"), tag(w).alias("lang"))), lambda t: t["lang"].isNotNull())
    empty = F.expr("cast(array() as array<struct<start_pos:int,end_pos:int,from_lang:string,to_lang:string,text_segment:string>>)")

    def moved(tagged: Column) -> Column:
        """Tagged tokens whose language isn't that of the one before, with that language."""
        before = lambda i: F.get(tagged, i - 1)["lang"]
        pairs = F.transform(tagged, lambda t, i: F.struct(t["word"].alias("word"), t["lang"].alias("lang"), before(i).alias("last")))
        return F.filter(pairs, lambda t: t["last"].isNotNull() & (t["last"] != t["lang"]))

    def placed(found: Column, lower: Column) -> Column:
        """Each known word is looked for once: there are as many as the markers."""
        known = F.array_distinct(F.transform(found, lambda t: t["word"]))
        places = F.map_from_entries(F.transform(known, lambda w: F.struct(w, (F.position(w, lower) - 1).alias("at"))))
        at = lambda places, t: F.element_at(places, t["word"])
        switch = lambda places, t: F.struct(at(places, t).alias("start_pos"), (at(places, t) + F.length(t["word"])).alias("end_pos"), t["last"].alias("from_lang"), t["lang"].alias("to_lang"), t["word"].alias("text_segment"))
        return let(places, lambda places: F.transform(found, lambda t: switch(places, t)))

    return F.when(F.size(tokens) >= 2, let(F.lower(text), lambda lower: let(let(tagged, moved), lambda found: placed(found, lower)))).otherwise(empty)


def classify(text: Column, markers: Markers = Markers()) -> Column:
    """struct<classification, confidence, singlish_score, tamilish_score, english_score, matched_markers, code_switches, is_code_mixed>."""
    blank = is_blank(text)

    def of(tokens: Column) -> Column:
        switches = code_switches(F.coalesce(text, F.lit("")), tokens, markers)
        return let(scores(tokens, markers), lambda s: let(switches, lambda w: _classified(blank | (F.size(tokens) == 0), s, matched_markers(tokens, markers), w)))

    return let(ascii_tokens(F.coalesce(text, F.lit(""))), of)


def _classified(none: Column, s: Column, matched: Column, switches: Column) -> Column:
    both = (s["singlish"] >= ENOUGH) & (s["tamilish"] >= ENOUGH)
    kind = (
        F.when(none, "unknown").when(both, "mixed").when(s["singlish"] >= ENOUGH, "singlish").when(s["tamilish"] >= ENOUGH, "tamilish").otherwise("pure_english")
    )
    confidence = (
        F.when(kind == "unknown", 0.0).when(kind == "mixed", F.greatest(s["singlish"], s["tamilish"]))
        .when(kind == "singlish", F.least(F.lit(1.0), s["singlish"] + 0.3)).when(kind == "tamilish", F.least(F.lit(1.0), s["tamilish"] + 0.3))
        .otherwise(s["english"])
    )
    zero = lambda c: F.when(none, 0.0).otherwise(c)
    return F.struct(
        kind.alias("classification"), confidence.alias("confidence"), zero(s["singlish"]).alias("singlish_score"),
        zero(s["tamilish"]).alias("tamilish_score"), zero(s["english"]).alias("english_score"),
        matched.alias("matched_markers"), switches.alias("code_switches"), (F.size(switches) > 0).alias("is_code_mixed"),
    )


def is_romanized(classification: Column) -> Column:
    return classification.isin("singlish", "tamilish", "mixed")


def translation_language(result: Column) -> Column:
    """The native language a romanized text stands for; a mixed text goes by the larger score, a tie to Tamil."""
    kind = result["classification"]
    larger = F.when(result["singlish_score"] > result["tamilish_score"], "sinhala").otherwise("tamil")
    return F.when(kind == "singlish", "sinhala").when(kind == "tamilish", "tamil").when(kind == "mixed", larger)
