"""Intents of a query, by patterns."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import INTENT_EXAMPLES, INTENTS
from .textkit import bounded, is_blank, let


_GROUP = re.compile(r"\(\?:([^()]*)\)(\?)?")


def needed(body: str) -> list[str]:
    """Strings of which each match of a body has one, in lower case: the longest sure run of letters of each alternative.

    A body has alternatives at the top, groups without groups in them, optional groups and letters, and white space.
    """
    def runs(part: str) -> list[str]:
        return re.split(r"[a-z0-9]\?|\\s[+*]|\x00", part)

    groups: list[str] = []
    whole = _GROUP.sub(lambda m: groups.append("" if m[2] else m[1]) or "\x00", body)
    found, at = [], 0
    for part in whole.split("|"):
        inner = groups[at : at + part.count("\x00")]
        at += len(inner)
        own = max(runs(part), key=len)
        # a group that must be there stands for the alternative where its own letters say little
        sure = [[max(runs(x), key=len) for x in g.split("|")] for g in inner if g]
        found += max([[own], *sure], key=lambda words: min(map(len, words)))
    return found


def scored(text: Column, intents: dict[str, tuple[str, ...]] = INTENTS) -> Column:
    """array<struct<rank, ordinal, intent, score, patterns>>, best first; patterns are named intent:number."""
    return let(text, lambda text: let(F.lower(text), lambda lower: _scored(text, lower, intents)))


def _scored(text: Column, lower: Column, intents: dict[str, tuple[str, ...]]) -> Column:
    # a plain look-up in the lower-cased text rules most patterns out; only ASCII letters match in either case
    may = lambda body: reduce(or_, (F.contains(lower, F.lit(x)) for x in dict.fromkeys(needed(body))))
    rows = []
    for i, (intent, bodies) in enumerate(intents.items()):
        names = F.array(*[F.when(may(b) & text.rlike("(?i)" + bounded(b)), F.lit(f"{intent}:{k}")) for k, b in enumerate(bodies, 1)])
        rows.append(F.struct(F.lit(i).alias("ordinal"), F.lit(intent).alias("intent"), F.filter(names, lambda x: x.isNotNull()).alias("patterns")))
    hit = F.filter(F.array(*rows), lambda r: F.size(r["patterns"]) > 0)
    score = lambda r: F.least(F.size(r["patterns"]) * 0.3 + 0.4, F.lit(1.0))
    return F.array_sort(F.transform(hit, lambda r: F.struct((-score(r)).alias("rank"), r["ordinal"].alias("ordinal"), r["intent"].alias("intent"), score(r).alias("score"), r["patterns"].alias("patterns"))))


def classify(text: Column, intents: dict[str, tuple[str, ...]] = INTENTS) -> Column:
    """struct<intent, confidence, matched_patterns, secondary_intents>."""
    return let(scored(F.coalesce(text, F.lit("")), intents), lambda found: _classified(text, found))


def _classified(text: Column, found: Column) -> Column:
    best = F.get(found, F.lit(0))
    asks = F.coalesce(text.contains("?"), F.lit(False))
    some, blank = F.size(found) > 0, is_blank(text)
    secondary = F.transform(F.filter(F.slice(found, 2, 2), lambda r: r["score"] > 0.3), lambda r: F.struct(r["intent"].alias("intent"), r["score"].alias("score")))
    nothing = F.expr("cast(array() as array<string>)")
    return F.struct(
        F.when(~blank & some, best["intent"]).when(~blank & asks, "general_info").otherwise("unknown").alias("intent"),
        F.when(~blank & some, best["score"]).when(~blank & asks, 0.3).otherwise(0.0).alias("confidence"),
        F.when(~blank & some, best["patterns"]).when(~blank & asks, F.array(F.lit("question_mark"))).otherwise(nothing).alias("matched_patterns"),
        F.when(~blank, secondary).otherwise(F.slice(secondary, 1, 0)).alias("secondary_intents"),
    )


def examples(spark, intent: str | None = None):
    """Example sentences of an intent (or of all) as a DataFrame (intent, text)."""
    rows = [r for r in INTENT_EXAMPLES if intent in (None, r[0])]
    return spark.createDataFrame(rows, "intent string, text string")
