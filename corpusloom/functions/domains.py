"""Domains of a text, by keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import DOMAIN_DESCRIPTIONS, DOMAINS
from .textkit import let, quote, whole, words


def _simple(keywords) -> list[str]:
    """The keywords that are looked up among the words."""
    return [k for k in keywords if k.isascii() and k.isalnum()]


def _own(lower: Column, keywords) -> Column:
    """Those of the words that are keywords: few, so that each look-up is short."""
    return F.array_intersect(words(lower), F.array(*[F.lit(k.lower()) for k in _simple(keywords)]).cast("array<string>"))


def _matched(text: Column, lower: Column, own: Column, keywords: tuple[str, ...], indic: bool) -> Column:
    """Distinct keywords found, in the lexicon's order. Single ASCII words are looked up among the words."""
    simple = _simple(keywords)
    tests = []
    for k in keywords:
        if k in simple:
            test = F.array_contains(own, k.lower())
        elif indic and not k.isascii():
            # marks belong to the word, so a keyword may end in one
            test = text.rlike(rf"(?<![\p{{L}}\p{{M}}\p{{N}}_]){quote(k)}(?![\p{{L}}\p{{M}}\p{{N}}_])")
        else:
            # the plain look-up rules nearly all texts out; a long s also counts as an s where case doesn't
            test = (F.contains(lower, F.lit(k.lower())) | F.contains(text, F.lit("\u017f"))) & text.rlike("(?iu)" + whole(k))
        tests.append(F.when(test, F.lit(k)))
    return F.filter(F.array(*tests), lambda x: x.isNotNull())


def tag(text: Column, domains: dict[str, tuple[str, ...]] = DOMAINS, indic_boundaries: bool = False) -> Column:
    """struct<primary_domain, confidence, all_domains, keywords_found>.

    By default words end at combining marks, as in Python's regular expressions, so some Indic keywords
    never match before a space; ``indic_boundaries`` keeps marks within words.
    """
    t = F.coalesce(text, F.lit(""))
    score = lambda r: F.least(F.size(r["keywords"]) * 0.25 + 0.4, F.lit(1.0))

    def hits(lower: Column, own: Column) -> Column:
        rows = [
            F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("domain"), _matched(t, lower, own, keywords, indic_boundaries).alias("keywords"))
            for i, (name, keywords) in enumerate(domains.items())
        ]
        return F.filter(F.array(*rows), lambda r: F.size(r["keywords"]) > 0)

    def ranked(hit: Column) -> Column:
        return F.array_sort(F.transform(hit, lambda r: F.struct((-score(r)).alias("rank"), r["ordinal"].alias("ordinal"), r["domain"].alias("domain"), score(r).alias("confidence"), r["keywords"].alias("keywords"))))

    found = let(F.lower(t), lambda lower: let(_own(lower, [k for own in domains.values() for k in own]), lambda own: hits(lower, own)))
    return let(found, lambda hit: let(ranked(hit), lambda best: _tagged(t, hit, best)))


def _tagged(t: Column, hit: Column, ranked: Column) -> Column:
    best = F.get(ranked, F.lit(0))
    return F.struct(
        F.coalesce(best["domain"], F.lit("general")).alias("primary_domain"),
        F.when(F.size(hit) > 0, best["confidence"]).when(F.length(t) == 0, 0.0).otherwise(0.3).alias("confidence"),
        F.transform(ranked, lambda r: F.struct(r["domain"].alias("domain"), r["confidence"].alias("confidence"), r["keywords"].alias("matched_keywords"))).alias("all_domains"),
        F.flatten(F.transform(hit, lambda r: r["keywords"])).alias("keywords_found"),
    )


def keywords_of(text: Column, domain: str, domains: dict[str, tuple[str, ...]] = DOMAINS) -> Column:
    """Distinct keywords of one domain in the text, sorted, in the text's own spelling lowered."""
    t = F.coalesce(text, F.lit(""))
    return F.array_sort(F.array_distinct(F.transform(_matched(t, F.lower(t), words(F.lower(t)), domains[domain], False), lambda k: F.lower(k))))


def description(domain: Column) -> Column:
    pairs = [F.lit(x) for kv in DOMAIN_DESCRIPTIONS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), domain), F.lit("Unknown domain"))
