"""Quality scores learned from preference pairs (Bradley-Terry), thresholded by a score quantile.

A document is described by what its text looks like: shares of symbols, capitals, digits and marks,
repeated words, windows and lines, word and line lengths. Every row labelled 1 is preferred to every row
labelled 0; the mean logistic loss on the differences of their descriptions, over all such pairs, gives the
weights, by Newton steps with a ridge. The cut is the quantile of all labelled rows' scores at the share of
label 0, and the published score is the logistic of the distance to the cut, so that the cut lies at the
decision threshold.

The pairs are never listed. A pair's loss depends on the difference of two scores, and the logistic is smooth,
so each row's share in the sums is laid on the ``NODES`` Chebyshev nodes of the unit cell of its score
(:func:`node_sums`), and nodes meet instead of rows, which is exact to some 1e-12 of the mean. A step reads the
labelled rows twice, and what comes to the driver is bounded by the cells that scores reach, whatever the rows.
The quantile is an exact order statistic, found by counts in ever narrower bins.

The descriptions of all documents are computed in one pass over whole texts.

Defined results: null and empty texts and texts of white space have the description of no words and are
scored like any other; without both labels every score is 0.5; several label rows of one
id each count; null labels are left out; repeated documents each get a row; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, fold, map_arrow, utf8
from .host_rules import repeated_words

#: Chebyshev nodes of a unit cell of scores, and bins of a pass for the quantile.
NODES, BINS = 12, 4096
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_SETS = (_UPPER, b"0123456789", b"#*$%&", b"|<>{}[]\\^~=_", b"!?", b".,;:", b"\n", b"@/", b"'\"()")
N_SHARES = len(_SETS) + 11
WIDTH = 2 * N_SHARES + 2


def describe(text: bytes) -> np.ndarray:
    """The description of a whole text: shares in [0, 1], their square roots, and two lengths."""
    out = np.zeros(WIDTH)
    words = text.split()
    n = len(words)
    if not n:
        return out
    size = len(text)
    shares = [(size - len(text.translate(None, s))) / size for s in _SETS]
    shares.append(len(text.translate(None, _LETTERS)) / size)
    caps = sum(w.isupper() for w in words)
    marked = sum(w[-1] in b"#*$%&|!" for w in words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    lines = text.split(b"\n")
    filled = [x for x in lines if x.strip()]
    shares += [
        caps / n, marked / n, same / n, repeated_words(words) / n, len(set(words)) / n,
        1 - len(set(filled)) / len(filled), sum(len(x) < 30 for x in filled) / len(filled),
        min(1.0, sum(map(len, words)) / n / 20), min(1.0, len(max(words, key=len)) / 100), min(1.0, n / 50),
    ]
    out[:N_SHARES] = shares
    out[N_SHARES : 2 * N_SHARES] = np.sqrt(shares)
    out[-2], out[-1] = math.log1p(n) / 10, min(1.0, math.log1p(n) / 5)
    return out


def descriptions(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and features (array of floats) of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([describe(x) for x in utf8(batch.column(1))], np.float32).reshape(-1, WIDTH)
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * WIDTH)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], ["doc_id", "features"])

    return map_arrow(docs, [id, text], run, f"doc_id {docs.schema[id].dataType.simpleString()}, features array<float>")


# -- sums over all pairs --
_AT = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)
_TO_NODES = np.polynomial.chebyshev.chebvander(_AT, NODES - 1).T * np.r_[1.0, np.full(NODES - 1, 2.0)][:, None] / NODES


def _shares(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each score and its shares of the cell's nodes: a smooth function there is the shares' sum of its values at the nodes."""
    cells = np.floor(scores).astype(np.int64)
    return cells, np.polynomial.chebyshev.chebvander(2 * (scores - cells) - 1, NODES - 1) @ _TO_NODES


def node_sums(features: np.ndarray, labels: np.ndarray, w: np.ndarray) -> dict[int, np.ndarray]:
    """2 * cell + label: for each node of the cell, the rows' shares and the descriptions summed by share."""
    out = {}
    for side in (0, 1):
        x = features[labels == side]
        cells, shares = _shares(x @ w)
        for c in np.unique(cells).tolist():
            at = cells == c
            out[2 * c + side] = shares[at].T @ np.column_stack([np.ones(at.sum()), x[at]])
    return out


def curved_sums(features: np.ndarray, labels: np.ndarray, w: np.ndarray, curve: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """0: the squares of the rows' descriptions, by the curvature that ``curve`` has at the nodes of their cells."""
    total = np.zeros((len(w), len(w)))
    for side in (0, 1):
        x = features[labels == side]
        cells, shares = _shares(x @ w)
        for c in np.unique(cells).tolist():
            at = cells == c
            total += (x[at] * (shares[at] @ curve[2 * c + side])[:, None]).T @ x[at]
    return {0: total}


def _meet(sums: dict[int, np.ndarray], block: int = 512) -> tuple[float, np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Over all pairs: the mean log likelihood, its gradient, the mixed part of the curvature, and the curvature at the nodes."""
    keys = [sorted(k for k in sums if k % 2 == side) for side in (0, 1)]
    at = [np.concatenate([k // 2 + (_AT + 1) / 2 for k in ks]) for ks in keys]
    bad, good = (np.concatenate([sums[k] for k in ks]) for ks in keys)
    mass_bad, mass_good = bad[:, 0], good[:, 0]
    n = mass_bad.sum() * mass_good.sum()
    value, gradient, mixed = 0.0, np.zeros(good.shape[1] - 1), np.zeros((good.shape[1] - 1,) * 2)
    curve_bad, curve_good = np.zeros(len(bad)), np.zeros(len(good))
    for i in range(0, len(good), block):  # bounded blocks of nodes
        part, mass = good[i : i + block], mass_good[i : i + block]
        d = at[1][i : i + block, None] - at[0][None, :]
        small = np.exp(-np.abs(d))
        miss = np.where(d > 0, small, 1.0) / (1 + small)
        curve = small / (1 + small) ** 2
        value += mass @ (np.minimum(d, 0) - np.log1p(small)) @ mass_bad
        gradient += (miss @ mass_bad) @ part[:, 1:] - (mass @ miss) @ bad[:, 1:]
        mixed += part[:, 1:].T @ curve @ bad[:, 1:]
        curve_good[i : i + block] = curve @ mass_bad / n
        curve_bad += mass @ curve / n
    curves = {k: c[NODES * i : NODES * i + NODES] for ks, c in zip(keys, (curve_bad, curve_good)) for i, k in enumerate(ks)}
    return value / n, gradient / n, mixed / n, curves


def bradley_terry(nodes: Callable[[np.ndarray], dict], curved: Callable[[np.ndarray, dict], dict], width: int = WIDTH, ridge: float = 1e-3) -> np.ndarray:
    """Weights that maximise the mean likelihood of rows labelled 1 over rows labelled 0, on all pairs; zero without both.

    ``nodes(w)`` gives :func:`node_sums` of all rows, ``curved(w, curve)`` their :func:`curved_sums`.
    """
    w, sums = np.zeros(width), nodes(np.zeros(width))
    if len({k % 2 for k in sums}) < 2:
        return w
    value, gradient, mixed, curves = _meet(sums)
    for _ in range(30):
        hessian = curved(w, curves)[0] - mixed - mixed.T + ridge * np.eye(width)
        step = np.linalg.solve(hessian, gradient - ridge * w)
        step *= min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        before = value - ridge / 2 * w @ w
        while True:  # a step that leads down is halved
            value, gradient, mixed, curves = _meet(nodes(w + step))
            if np.abs(step).max() < 1e-6 or value - ridge / 2 * (w + step) @ (w + step) >= before:
                break
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


# -- passes over the labelled rows --
def _total(learn: DataFrame, function: Callable[[np.ndarray, np.ndarray], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """What ``function`` gives for features and labels, summed by key over all rows, in the order of the partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            features = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, WIDTH)
            for k, x in function(features, batch.column(1).to_numpy(zero_copy_only=False)).items():
                sums[k] = sums[k] + x if k in sums else x
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([part] * len(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["key", "part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("part").to_pylist(), table.column("sums").to_pylist()))
        total = sum(np.frombuffer(x) for _, x in parts)
        return pa.table([table.column("key").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["key", "sums"])

    rows = learn.select("features", "y").mapInArrow(run, "key long, part long, sums binary").groupBy("key").applyInArrow(add, "key long, sums binary")
    return {r["key"]: np.frombuffer(r["sums"]) for r in rows.collect()}


def _fit(learn: DataFrame) -> np.ndarray:
    def nodes(w: np.ndarray) -> dict[int, np.ndarray]:
        return {k: x.reshape(NODES, -1) for k, x in _total(learn, lambda x, y: node_sums(x, y, w)).items()}

    def curved(w: np.ndarray, curve: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        return {k: x.reshape(WIDTH, -1) for k, x in _total(learn, lambda x, y: curved_sums(x, y, w, curve)).items()}

    return bradley_terry(nodes, curved)


def midpoint(values: DataFrame, below: int) -> float:
    """Halfway between the greatest of the ``below`` least values of the only column and the next value."""
    v = F.col(values.columns[0])
    low, high = values.agg(F.min(v), F.max(v)).first()
    rank = below - 1
    while low < high:
        place = F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1))
        for r in sorted(values.where(v.between(low, high)).groupBy(place.alias("place")).agg(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).collect()):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    upto, after = values.agg(F.count_if(v <= low), F.min(F.when(v > low, v))).first()
    return low if upto > below else (low + after) / 2


def _raw(w: np.ndarray) -> Column:
    total = F.lit(0.0)
    for i, x in enumerate(w.tolist()):
        total = total + F.col("features")[i].cast("double") * F.lit(x)
    return total


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text", folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows of the held-out fold aren't learned from."""
    described = checkpoint(descriptions(docs, id, text))
    chosen = labels.select(F.col(id).alias("l_id"), F.col(label).cast("double").alias("y")).where(F.col("y").isNotNull() & (fold("l_id", folds) != held_out))
    learn = described.join(chosen, described["doc_id"] == chosen["l_id"]).select("doc_id", "y", "features")
    learn = checkpoint(learn.repartition("doc_id").sortWithinPartitions("doc_id", "y", "features"))
    n = {r["y"]: r["n"] for r in learn.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    w, offset = np.zeros(WIDTH), 0.0
    if n.get(0.0) and n.get(1.0):
        w = _fit(learn)
        offset = math.log(threshold / (1 - threshold)) - midpoint(learn.select(_raw(w).alias("raw")), n[0.0])
    out = described.withColumn("score", 1 / (1 + F.exp(-(_raw(w) + F.lit(offset))))).withColumn("held_out", fold("doc_id", folds) == held_out)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
