"""Toxicity by weak supervision.

Voters look at a text and speak or abstain; none of them reads a label when it votes:

* lexicon voters speak for a word: words of a general list of insults in four languages, and words that lean
  towards the toxic rows of a bounded labelled sample;
* pattern voters speak for a word beginning of three to eight letters that leans so, which covers a stem and all
  its inflections, or for two, three or five different words that begin so; a word or beginning is left out
  where a shorter beginning, or fewer words, say the same about as surely;
* form voters speak for shouting, for strings of exclamation marks, for sentences that end properly, for length,
  and one, against toxicity, for the silence of all words and beginnings.

A generative label model then estimates by expectation maximisation how accurate each voter is, starting from a
prior (for words and beginnings their accuracy in the labelled sample, for unseen words of the lexicon
``TRUSTED``, worth ``WEIGHT`` votes), how often form voters speak in either class, and, in the same rounds, the
correlations of all pairs of voters within the classes: a vote's log odds count by one over one plus what it
shares with the other voters that speak on the row. Labels set the class balance, the prior, and which words become voters; no label takes part in
the posterior of its row. Of copies and near copies one is learned from (:func:`families`). The posteriors train a logistic classifier on the same voters, and that classifier alone
scores the documents, each by its whole text; even odds lie at the score ``threshold``.

What comes to the driver is bounded by ``SAMPLE`` labelled rows and by the words of these that stand in
``LEAST`` toxic ones at least; the broadcast weights are bounded by those words too.

Defined results: null and empty texts hold no terms and get the score of no evidence; without toxic rows
in the sample every document gets the (low) score of no evidence; several label rows of one id each count;
null labels are left out; repeated documents each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, checkpoint, fold, fresh, map_arrow, utf8

SAMPLE, LEAST = 20_000, 4
TRUSTED, WEIGHT = 0.9, 100.0
BEGINNINGS, TIMES = (3, 4, 5, 6, 7, 8), (1, 2, 3, 5)
#: A general list of insults: public vocabulary, taken from no table.
LEXICON = tuple(
    "idiot idiots stupid moron morons loser losers pathetic worthless disgusting trash scum clown dumb fool fools jerk imbecile ugly filthy vermin coward liar pig rat freak creep garbage hate "
    "dumm dummkopf trottel arschloch abschaum widerlich erbärmlich schwein versager hässlich ekelhaft "
    "imbécile crétin abruti ordure minable répugnant dégoûtant salaud connard stupide "
    "idiota estúpido imbécil basura asqueroso patético escoria inútil perdedor payaso tonto".split()
)
FORMS = ("shouting", "marks", "ended", "long", "silent")
_WORD = re.compile(r"\w+")
_CACHE = 1 << 19


def terms_of(run: str) -> set[str]:
    """Terms of a run of text without white space: ``=word`` and ``beginning-`` in lower case."""
    found = set()
    for word in _WORD.findall(run.lower()):
        found.add("=" + word)
        found.update(word[:k] + "-" for k in BEGINNINGS if len(word) > k)
    return found


def levelled(counts: Counter) -> list[str]:
    """``=word`` as it is, ``beginning-k`` with the greatest of ``TIMES`` that its number of words reaches."""
    return [t if t[0] == "=" else f"{t}{max(k for k in TIMES if n >= k)}" for t, n in counts.items()]


def forms_of(text: bytes, spoken: bool) -> list[int]:
    """Numbers of the form voters that speak on a whole text; ``spoken``: whether any term does."""
    words, marks, stops = text.count(b" ") + text.count(b"\n") + 1, text.count(b"!"), text.count(b".")
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    tests = (4 * upper > len(text) > 0, 20 * marks > words, 25 * stops > words, words > 100, not spoken)
    return [i for i, yes in enumerate(tests) if yes]


class Finder:
    """The numbers of the voters that speak on whole texts; remembers the runs it met, up to a bound."""

    def __init__(self, terms: list[str]):
        self.number = {t: i + len(FORMS) for i, t in enumerate(terms)}
        self.parts = {t if t[0] == "=" else t[:-1] for t in self.number}
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: bytes) -> list[int]:
        known, number, found = self.known, self.number, []
        if len(known) > _CACHE:
            known.clear()
        for run in set(text.decode("utf-8", "replace").split()):
            hits = known.get(run)
            if hits is None:
                hits = tuple(t for t in terms_of(run) if t in self.parts)
                if len(run) < 64:
                    known[run] = hits
            if hits:
                found += hits
        spoken = {number[t] for t in levelled(Counter(found)) if t in number}
        return forms_of(text, bool(spoken)) + sorted(spoken)


def families(rows: DataFrame) -> DataFrame:
    """One row, of the least id, for each family of copies: those whose least shingle of five words is the same.

    Thousands of copies of one text would turn all its words into evidence.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        least = []
        for text in utf8(batch.column(1)):
            words = text.split()
            grams = map(b" ".join, zip(*(words[i:] for i in range(5)))) if len(words) > 5 else [b" ".join(words)]
            least.append(min(map(xxhash.xxh64_intdigest, grams)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(least, np.uint64).view(np.int64))], ["d_id", "text", "y", "family"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    named = checkpoint(map_arrow(rows, ["d_id", "text", "y"], run, f"{fields}, family long"))
    least = named.groupBy("family").agg(F.min("d_id").alias("d_id"))
    return named.join(least, ["family", "d_id"], "left_semi").select("d_id", "text", "y")


def candidate_terms(sample: DataFrame, least: int = LEAST, lean: float = 1.0) -> dict[str, float]:
    """Prior accuracies of the lexicon, and of the words and beginnings whose log odds among toxic rows surely exceed ``lean``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded(batch, 2 << 20):  # the terms of a slice take some fifty times its bytes
                counts: dict[str, list[int]] = {}
                for text, y in zip(utf8(part.column(0)), part.column(1).to_pylist()):
                    for term in levelled(Counter(t for run in set(text.decode("utf-8", "replace").split()) for t in terms_of(run))):
                        counts.setdefault(term, [0, 0])[int(y == 1)] += 1
                names = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([counts[t][1] for t in names], pa.int64()), pa.array([counts[t][0] for t in names], pa.int64())],
                    ["term", "toxic", "clean"],
                )

    totals = sample.agg(F.sum((F.col("y") == 1).cast("long")), F.sum((F.col("y") != 1).cast("long"))).first()
    toxic, clean = totals[0] or 0, totals[1] or 0
    counted = sample.select("text", "y").mapInArrow(run, "term string, toxic long, clean long")
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= least)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    sure = odds - 2 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    balance = (toxic + 0.5) / (toxic + clean + 1)
    kept = {r[0]: (r[1] + 2 * balance) / (r[1] + r[2] + 2) for r in counted.where(sure > lean).select("term", "toxic", "clean").collect()}
    return dict(sorted(({"=" + w: TRUSTED for w in LEXICON} | kept).items()))


class Votes:
    """Sparse votes: which voter spoke on which row."""

    def __init__(self, hits: list[list[int]], voters: int):
        self.rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
        self.terms = np.array([t for h in hits for t in h], np.int64)
        self.n, self.m = len(hits), voters

    def by_term(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.terms, weight[self.rows], self.m)

    def by_row(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weight[self.terms], self.n)

    def columns(self, first: int, last: int) -> np.ndarray:
        """Rows by voters from ``first`` to ``last``, ones where a voter spoke."""
        out = np.zeros((self.n, last - first), np.float32)
        mine = (self.terms >= first) & (self.terms < last)
        out[self.rows[mine], self.terms[mine] - first] = 1
        return out


def correlations(votes: Votes, q: np.ndarray, block: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """(first voter, matrix) by blocks of voters: correlations with all voters among rows weighted by ``q``."""
    total = max(float(q.sum()), 1e-9)
    rate = votes.by_term(q) / total
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9))
    weight = q.astype(np.float32)[:, None]
    for a in range(0, votes.m, block):
        mine = votes.columns(a, min(votes.m, a + block)) * weight
        out = np.empty((mine.shape[1], votes.m), np.float32)
        for b in range(0, votes.m, block):
            end = min(votes.m, b + block)
            both = mine.T @ votes.columns(b, end) / total
            out[:, b:end] = (both - np.outer(rate[a : a + block], rate[b:end])) / np.outer(spread[a : a + block], spread[b:end])
        out[np.arange(len(out)), a + np.arange(len(out))] = 0
        yield a, out


def shares(votes: Votes, q: np.ndarray, least: float = 0.1) -> np.ndarray:
    """What of each vote's log odds is its own: one over one plus its correlations with the row's other voters."""
    shared = np.zeros(len(votes.rows))
    for weight, part in ((q, q.mean()), (1 - q, 1 - q.mean())):
        for a, rho in correlations(votes, weight):
            beside = np.zeros((votes.n, len(rho)), np.float32)
            rho = np.where(rho > least, rho, 0)
            for b in range(0, votes.m, 256):
                beside += votes.columns(b, min(votes.m, b + 256)) @ rho[:, b : b + 256].T
            mine = np.flatnonzero((votes.terms >= a) & (votes.terms < a + len(rho)))
            shared[mine] += part * beside[votes.rows[mine], votes.terms[mine] - a]
    return 1 / (1 + shared)


class Model:
    """What the label model estimates: accuracies of the voters for toxicity, shares of the votes, the posteriors."""

    def __init__(self, accuracy: np.ndarray, share: np.ndarray, posterior: np.ndarray):
        self.accuracy, self.share, self.posterior = accuracy, share, posterior


def label_model(votes: Votes, balance: float, prior: np.ndarray, weight: np.ndarray, rounds: int = 30) -> Model:
    """Accuracies and correlations of the voters by expectation maximisation; no label is read.

    A voter's accuracy is the probability of the toxic class where it speaks; below ``balance`` it speaks
    against it. ``prior`` counts as ``weight`` votes; zero weight leaves an accuracy to the votes. Rows
    start from what the priors say, the posteriors' mean is held at the balance, so that voters can't carry
    each other away from it, and correlations are estimated in the first, third and ninth round.
    """
    logit = lambda p: np.log(p / (1 - p))
    spoken, accuracy, share = votes.by_term(np.ones(votes.n)), np.clip(prior, 0.005, 0.995), np.ones(len(votes.rows))
    q = np.full(votes.n, balance)
    for k in range(rounds):
        said = share * (logit(accuracy) - logit(balance))[votes.terms]
        new = _balanced(np.bincount(votes.rows, said, votes.n), balance)
        done = np.abs(new - q).max() < 1e-4
        q = new
        if done:
            break
        if k in (0, 2, 8):
            share = shares(votes, q)
        accuracy = np.clip((votes.by_term(q) + weight * prior + balance) / (spoken + weight + 1), 0.005, 0.995)
    return Model(accuracy, share, q)


def _balanced(odds: np.ndarray, balance: float) -> np.ndarray:
    """Probabilities of odds shifted so that their mean is the balance."""
    low, high = -60.0, 60.0
    for _ in range(60):
        middle = (low + high) / 2
        p = 1 / (1 + np.exp(-np.clip(odds + middle, -30, 30)))
        low, high = (middle, high) if p.mean() < balance else (low, middle)
    return p


def linear_classifier(votes: Votes, target: np.ndarray, rounds: int = 400, ridge: float = 3e-5, rate: float = 0.2) -> tuple[np.ndarray, float]:
    """Logistic regression of posterior labels on the voters (Adam, full batches)."""
    w, b = np.zeros(votes.m), math.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    m1, m2, c1, c2 = np.zeros(votes.m), np.zeros(votes.m), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(b + votes.by_row(w), -30, 30)))
        e = p - target
        g, gb = votes.by_term(e) / votes.n + ridge * w, float(e.mean())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        c1, c2 = 0.9 * c1 + 0.1 * gb, 0.999 * c2 + 0.001 * gb * gb
        w -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        b -= rate * (c1 / (1 - 0.9**t)) / (math.sqrt(c2 / (1 - 0.999**t)) + 1e-8)
    return w, b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", folds: int = 3, held_out: int = 1, sample: int = SAMPLE, threshold: float = 0.7) -> tuple[list[str], np.ndarray, float]:
    """Terms, weights and offset learned from at most ``sample`` labelled rows outside the held-out fold."""
    chosen = labels.select(F.col(id).alias("l_id"), F.col(label).alias("y")).where(F.col("y").isNotNull() & (fold("l_id", folds) != held_out))
    chosen = chosen.orderBy(F.xxhash64("l_id", F.lit(42)), "l_id", "y").limit(sample)
    rows = docs.select(F.col(id).alias("d_id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("d_id") == F.col("l_id")).select("d_id", "text", "y")
    rows = checkpoint(families(rows))
    known = candidate_terms(rows)
    terms = list(known)
    finder = Finder(terms)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [finder(x) for x in utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, pa.list_(pa.int32())), batch.column(2)], ["d_id", "hits", "y"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    found = map_arrow(rows, ["d_id", "text", "y"], run, f"d_id {kinds['d_id']}, hits array<int>, y {kinds['y']}").orderBy("d_id", "hits").toPandas()
    y = (found["y"].to_numpy() == 1).astype(int)
    if not len(y) or not y.any():
        return [], np.zeros(len(FORMS)), math.log(0.01 / 0.99)
    votes = Votes([list(h) for h in found["hits"]], len(FORMS) + len(terms))
    balance = min(0.9, (y.sum() + 0.5) / (len(y) + 1))
    # forms start at the balance, the silent one at half of it, and are left to the votes
    prior = np.array([balance, balance, balance, balance, balance / 2, *known.values()])
    weight = np.array([0.0] * len(FORMS) + [WEIGHT] * len(terms))
    weights, offset = linear_classifier(votes, label_model(votes, float(balance), prior, weight).posterior)
    # the decision at even odds lies at the score that is the threshold
    return terms, weights, offset + math.log(threshold / (1 - threshold))


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", folds: int = 3, held_out: int = 1, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows of the held-out fold aren't learned from."""
    scored = _apply(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"], *train(docs, labels, label, id, text, folds, held_out, sample, threshold))
    scored = scored.withColumn("held_out", fold("doc_id", folds) == held_out)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _apply(docs: DataFrame, keep: list[str], terms: list[str], weights: np.ndarray, offset: float, name: str = "score", text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((Finder(terms), weights))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        finder, w = shared.value
        odds = np.array([offset + float(w[finder(x)].sum()) for x in utf8(batch.column(len(keep)))])
        scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(scores, pa.float64())], [*keep, name])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(docs, [*keep, text], run, f"{fields}, `{name}` double")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The documents, all their columns, that aren't scored toxic."""
    keep, name = docs.columns, fresh("score", docs.columns)
    model = train(docs, labels, threshold=threshold, **options)
    scored = _apply(docs, keep, *model, name, options.get("text", "text"))
    return scored.where(F.col(name) < threshold).select(*keep)
