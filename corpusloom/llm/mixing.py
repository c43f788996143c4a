"""Mixing sources to target weights by subset-sum budget fitting.

Sources, ordered by code point with null last, weigh 1, 2, 3, 1, ... and share the whole size of the
corpus; a target stops at ``most`` times its source's size and the excess is shared again by weight. A
source's documents are all taken ``target // size`` times; the rest of the budget is fitted exactly:
documents are counted by exact length, each length gives its proportional share, the longest lengths
that still fit fill up, and bounded-knapsack dynamic programming over what remains of every length
finds the subset sum nearest to the remaining budget. The number taken of each length then selects
documents in the order of a seeded hash.

What is gathered for one source is its table of lengths and counts, which distinct lengths bound, not
documents. Documents of one source and length are ranked within 256 slices of the hash, and only the
slice in which the last taken document lies needs a rank, so no hot group is sorted in one task.

Defined results: a null text has size 0; documents of size 0 are never taken; null is a source of its
own, last in order; repeated rows count and are ranked each for itself; ties in the hash fall to the id;
an empty table gives an empty result.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, checkpoint, fresh

SLICES = 256


def capped_targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> list[float]:
    """Targets of the sources, in the given order: shares by weight, capped, the excess reshared."""
    total = sum(s for _, s in sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    left = float(total)
    while free:
        w = sum(weight[i] for i in free)
        over = [i for i in free if left * weight[i] / w > most * sizes[i][1]]
        if not over:
            for i in free:
                target[i] = left * weight[i] / w
            break
        for i in over:
            target[i] = float(most * sizes[i][1])
        left = float(total - sum(most * sizes[i][1] for i in range(len(sizes)) if i not in set(free) - set(over)))
        free = [i for i in free if i not in set(over)]
    return target


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, width: int = 1 << 16) -> np.ndarray:
    """How many documents of each length to take so that their sizes sum up nearest to ``budget``.

    The proportional share and the fill leave a rest below the longest length that remains (or a corpus
    too small for the budget); the dynamic programme runs over that rest plus one longest length, at most
    ``width`` words wide. A rest beyond the width is filled by the longest lengths before; where all that
    is left is longer than the rest, the nearest sum is none or one of the shortest.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    take = np.zeros(len(lengths), np.int64)
    use = np.flatnonzero((lengths > 0) & (counts > 0))
    total = int((lengths[use] * counts[use]).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        take[use] = counts[use]
        return take
    take[use] = [int(c) * budget // total for c in counts[use].tolist()]
    rest = budget - int((lengths * take).sum())
    order = use[np.argsort(-lengths[use])]
    # Fill with the longest that fit, but keep a margin for the dynamic programme to work in.
    margin = min(width // 2, int(lengths[order[0]]))
    for i in order.tolist():
        more = min(int(counts[i] - take[i]), max(0, rest - margin) // int(lengths[i]))
        take[i] += more
        rest -= more * int(lengths[i])
    while rest > width:  # what is left of every length is longer than the rest less the margin
        fits = [i for i in order.tolist() if take[i] < counts[i] and lengths[i] <= rest]
        if not fits:  # every sum is 0 or at least the shortest that is left, which may be nearer
            left = [i for i in order.tolist() if take[i] < counts[i]]
            if left and int(lengths[left[-1]]) - rest < rest:
                take[left[-1]] += 1
            return take
        take[fits[0]] += 1
        rest -= int(lengths[fits[0]])
    found = take + knapsack(lengths, counts - take, rest)
    if budget <= width and int((lengths * found).sum()) != budget:  # few documents: all of them may do better
        return knapsack(lengths, counts, budget)
    return found


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum by dynamic programming: numbers of each length whose sum is nearest ``budget``.

    ``first[s]`` is the item with which sum s was first reached, so the choice is read back from it; each
    item is added to the sums of the items before it, as often as it is there. A sum above the budget wins
    only when nearer.
    """
    take = np.zeros(len(lengths), np.int64)
    items = [i for i in np.argsort(-lengths).tolist() if lengths[i] > 0 and counts[i] > 0]
    if budget <= 0 or not items:
        return take
    smallest = min(int(lengths[i]) for i in items)
    top = budget + smallest  # a nearest sum lies below that: 0 is as near as 2 * budget
    first = np.full(top + 1, -1, np.int32)
    first[0] = -2
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    for i in items:
        length, left = int(lengths[i]), min(int(counts[i]), top // int(lengths[i]))
        frontier = reached.copy()
        while left and length <= top:
            shifted = np.zeros(top + 1, bool)
            shifted[length:] = frontier[:-length]
            fresh = shifted & ~reached
            if not fresh.any():
                break
            first[fresh] = i
            reached |= fresh
            frontier = fresh  # one more of this length on top of sums just made with it
            left -= 1
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    s = int(sums[np.argmin(np.abs(sums - budget))])
    while s:
        i = int(first[s])
        take[i] += 1
        s -= int(lengths[i])
    return take


def mix(
    docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, most: int = 3
) -> DataFrame:
    """doc_id, source, size, source_size, target, times and taken (words, repeats counted) of every row, and ``content``, a hash of its text."""
    sized = docs.select(
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(text)).alias("content"),
    )
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"))
    sized = sized.withColumn("draw", draw).withColumn("slice", F.shiftrightunsigned("draw", 56).cast("int"))
    sized = checkpoint(sized)
    lengths = checkpoint(sized.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("docs")))
    # a row for each source comes to the driver: their names, sizes and nothing of the documents
    names = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("n")).collect()
    rows = sorted(((r[0], int(r[1])) for r in names), key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8")))
    targets = capped_targets(rows, most=most)
    spark = docs.sparkSession
    kind = docs.schema[source].dataType.simpleString()
    plan = spark.createDataFrame(
        [(s, n, t) for (s, n), t in zip(rows, targets)], f"source {kind}, source_size long, target double"
    )

    def fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = min(most, int(target // size)) if size else 0
        budget = int(round(target - whole * size)) if whole < most else 0
        by = pdf.sort_values("size")
        take = fit(by["size"].to_numpy(), by["docs"].to_numpy(), budget)
        return pd.DataFrame({"source": by["source"], "size": by["size"], "times": whole, "extra": take})

    counted = lengths.groupBy("source", "size").agg(F.sum("docs").alias("docs"))
    plan_key = plan.toDF("plan_source", "source_size", "target")
    with_target = counted.join(plan_key, counted["source"].eqNullSafe(plan_key["plan_source"]))
    fitted = with_target.select("source", "size", "docs", "source_size", "target").groupBy("source").applyInPandas(
        fit_source, f"source {kind}, size long, times int, extra long"
    )
    fitted = checkpoint(fitted).toDF("f_source", "f_size", "times", "extra")
    # documents before each slice, among those of its source and length: at most 256 rows a group
    before = F.coalesce(F.sum("docs").over(Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = lengths.withColumn("before", before)
    on = slices["source"].eqNullSafe(fitted["f_source"]) & (slices["size"] == fitted["f_size"])
    slices = slices.join(fitted, on).select(
        F.col("source").alias("s_source"), F.col("size").alias("s_size"), F.col("slice").alias("s_slice"), "times",
        F.least(F.greatest(F.col("extra") - F.col("before"), F.lit(0)), F.col("docs")).alias("want"), "docs",
    )
    on = sized["source"].eqNullSafe(slices["s_source"]) & (sized["size"] == slices["s_size"]) & (sized["slice"] == slices["s_slice"])
    joined = sized.join(slices, on)
    columns = ["doc_id", "source", "size", "content", "times", "draw", "slice", "want", "docs"]
    sure = joined.where((F.col("want") == 0) | (F.col("want") == F.col("docs"))).select(*columns)
    sure = sure.withColumn("more", (F.col("want") > 0).cast("int"))
    edge = joined.where((F.col("want") > 0) & (F.col("want") < F.col("docs"))).select(*columns)
    rank = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("draw", "doc_id", "content"))
    edge = edge.withColumn("more", (rank <= F.col("want")).cast("int"))
    out = sure.unionByName(edge)
    out = out.join(plan_key, out["source"].eqNullSafe(plan_key["plan_source"]))
    times = F.when(F.col("size") > 0, F.least(F.col("times") + F.col("more"), F.lit(most))).otherwise(0)
    out = out.withColumn("times", times.cast("int")).withColumn("taken", F.col("size") * F.col("times"))
    return out.select("doc_id", "source", "size", "source_size", "target", "times", "taken", "content")


def take(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, most: int = 3) -> DataFrame:
    """The mix itself: the documents, all their columns, each as often as it is taken.

    Rows that share id, source and text are taken as often in all as the mix says: evenly, and what is over
    by the order of their other columns.
    """
    mixed = mix(docs, id, source, text, seed, most)
    by = [F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("content").alias("_content")]
    groups = mixed.groupBy(*by).agg(F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_rows")).where("_times > 0")
    content = F.xxhash64(docs[text])
    on = docs[id].eqNullSafe(groups["_id"]) & docs[source].eqNullSafe(groups["_source"]) & (content == groups["_content"])
    joined = docs.join(groups, on)
    each = F.floor(F.col("_times") / F.col("_rows")).cast("int")
    over = (F.col("_times") % F.col("_rows")).cast("int")
    number = fresh("number", docs.columns)
    even = joined.where(over == 0).withColumn(number, each)
    order = [docs[f.name] for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rank = F.row_number().over(Window.partitionBy("_id", "_source", "_content").orderBy(*order))
    odd = joined.where(over > 0).withColumn(number, each + F.when(rank <= over, 1).otherwise(0))
    rows = even.union(odd).select(*(docs.columns), number)
    copies = rows.where(F.col(number) > 0).withColumn(number, F.explode(F.sequence(F.lit(1), F.col(number))))
    return copies.drop(number)
