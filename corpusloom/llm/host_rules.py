"""Host-level quality rules.

Every document is measured by fixed rules: too short, repetitive, full of symbols, full of repeated lines.
The failures of each rule are aggregated by host, and each host's rate is shrunk with a beta prior of that
rule, whose two parameters are estimated from all hosts by moments (empirical Bayes). A host is rejected
when, for any rule, the lower bound of its posterior rate (``SURE`` standard deviations below the mean) lies
above ``FACTOR`` times the hosts' mean rate, but never below ``LEAST`` and always above ``MOST``: it fails
surely more often than hosts do, and often. The verdict is joined back to the host's documents: a document
is kept when it passes the base rules itself and its host isn't rejected.

Defined results: a null text has no words and fails as too short; a null host is a host of its own; an
empty table gives an empty result; repeated rows each get a row; other columns, whatever their names,
are left out; where all hosts fail alike, or there is one host only, none stands out unless above ``MOST``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, map_arrow, utf8

_SPACES = b" \t\n\r\x0b\f"
_SYMBOLS = b"#*$%&|<>"
FACTOR, LEAST, MOST, SURE = 2.0, 0.25, 0.5, 1.645
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of that many words found twice or more, first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i:] for i in range(window))))
    first: dict[tuple, int] = {}
    ids = [first.setdefault(g, i) for i, g in enumerate(grams)]
    if len(first) == n:
        return 0
    ids = np.asarray(ids)
    often = np.bincount(ids, minlength=n)[ids] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + n] |= often
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()  # of bytes: exactly the six ASCII white-space characters
    if not words:
        return 0, 0, len(text) - len(text.translate(None, _SYMBOLS)), 0, 0
    chars = len(text.translate(None, _SPACES).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    repeats = 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                repeats += 1
            elif line.strip():
                seen.add(line)
    return len(words), chars, symbols, repeats, repeated_words(words)


def measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the five measures of each whole text."""
    names = [x.split()[0] for x in MEASURES.split(", ")]
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + MEASURES

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(x) for x in utf8(batch.column(len(keep)))]
        arrays = [batch.column(i) for i in range(len(keep))]
        arrays += [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
        return pa.RecordBatch.from_arrays(arrays, keep + names)

    return map_arrow(docs, [*keep, text], run, schema)


#: The rules whose failures are counted by host. The first two are the base rules.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "20 * n_dup_lines > n_words",
}


def base_failed() -> F.Column:
    return F.expr(RULES["short"]) | F.expr(RULES["repeats"])


def host_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row for each host: its documents, failures and lower bounded rate by rule, and verdict.

    A rule's prior is Beta(a, b) with the mean and the variance of the hosts' raw rates; where the rates don't
    vary the prior weighs as much as ``1e6`` documents of mean rate, so that a host is judged as the average is.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), *[F.sum(F.expr(rule).cast("long")).alias(f"failed_{name}") for name, rule in RULES.items()]
    )
    rates = {name: F.col(f"failed_{name}") / F.col("host_docs") for name in RULES}
    # one row whatever the size of the input: mean and variance of the hosts' rates for each rule
    moments = hosts.agg(*[f(rates[name]) for name in RULES for f in (F.avg, F.var_pop)]).first()
    rejected = F.lit(False)
    for i, name in enumerate(RULES):
        m, v = moments[2 * i] or 0.0, moments[2 * i + 1] or 0.0
        weight = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v > 1e-12 else 1e6
        total = F.col("host_docs") + weight
        mean = (F.col(f"failed_{name}") + m * weight) / total
        lower = mean - SURE * F.sqrt(mean * (1 - mean) / (total + 1))
        hosts = hosts.withColumn(f"rate_{name}", mean).withColumn(f"lower_{name}", lower)
        rejected = rejected | (F.col(f"lower_{name}") > min(MOST, max(LEAST, FACTOR * m)))
    return hosts.withColumn("host_rejected", rejected)


def apply(docs: DataFrame, id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Measures, base verdict, host verdict and ``kept`` of each document; texts are read once."""
    renamed = docs.select(F.col(id).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text"))
    measured = checkpoint(measures(renamed, ["doc_id", "source"]))
    hosts = host_verdicts(measured).select("host", "host_rejected")
    joined = measured.join(hosts, measured["source"].eqNullSafe(hosts["host"]), "left")
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    )
