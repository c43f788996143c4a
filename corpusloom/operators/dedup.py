"""Exact and near duplicates by token sets, and content versions."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.hashing import content_hash, delta_summary, token_words, word_count
from corpusloom.functions.textkit import PIECE, each


def exact_lookup(new: DataFrame, existing: DataFrame, new_id: str, old_id: str, text: str = "text") -> DataFrame:
    """Rows of ``new`` whose content hash an existing row has: new_id, original_id (the least), similarity 1."""
    known = existing.groupBy(content_hash(F.col(text)).alias("content_hash")).agg(F.min(old_id).alias("original_id"))
    hashed = new.select(F.col(new_id).alias("new_id"), content_hash(F.col(text)).alias("content_hash"))
    return hashed.join(known, "content_hash").select("new_id", "original_id", F.lit(1.0).alias("similarity"), F.lit(True).alias("is_exact"))


def duplicate_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """content_hash, first id and number of rows of each content that is there more than once."""
    return docs.groupBy(content_hash(F.col(text)).alias("content_hash")).agg(F.min(id).alias("first_id"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.9, least_tokens: int = 5) -> DataFrame:
    """Pairs (id_a < id_b) of different token sets, by their first ids, whose Jaccard index reaches the threshold.

    Rows of equal token sets are one class, named by its least id, so copies make no pairs; :func:`classes`
    gives the membership. Sets that reach the threshold differ in at most D tokens, and D follows from their sizes;
    of D + 1 parts into which tokens fall by hash, one at least is the same in both. Sets meet by their parts' names,
    8 bytes a part, and only those that meet are shuffled with their tokens and verified. Made for thresholds of
    0.8 and more; below, parts hold few tokens and many sets meet by chance.
    """
    sets = _sets(docs, id, text, least_tokens).withColumn("key", F.xxhash64("words"))
    named = sets.select("key", F.explode(_parts(threshold)(F.col("words"))).alias("p"))
    by = Window.partitionBy("part")
    shared = named.select("key", "p.part", "p.own").withColumns({"least": F.min("key").over(by), "most": F.max("key").over(by)}).where("least < most")
    members = shared.groupBy("part").agg(F.collect_set(F.struct("key", "own")).alias("members"))
    first = members.select("members", F.explode("members").alias("a")).where("a.own")
    met = first.select("a", F.explode("members").alias("b")).where("not b.own or a.key < b.key").select(F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b")).distinct()
    wanted = met.select(F.explode(F.array("key_a", "key_b")).alias("key")).distinct()
    reps = sets.join(wanted, "key", "left_semi").groupBy("key", "words").agg(F.min("id").alias("id"))
    side = lambda x: reps.select(F.col("key").alias(f"key_{x}"), F.col("id").alias(f"id_{x}"), F.col("words").alias(f"words_{x}"))
    both = met.join(side("a"), "key_a").join(side("b"), "key_b")
    similar = once(both, "similarity", F.arrow_udf(_jaccard, "double")(F.col("words_a"), F.col("words_b")))
    return similar.where(F.col("similarity") >= threshold).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "similarity")


def _jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    def of(a: str, b: str) -> float:
        a, b = set(a.split(" ")), set(b.split(" "))
        common = len(a & b)
        return common / (len(a) + len(b) - common)

    return each(of, pa.float64(), a, b)


def token_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number of 64 bits for each token of each row, and the rows' numbers of tokens; equal tokens have equal numbers."""
    words = pa.concat_arrays([words])
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    blank = data == 32
    # a token begins behind a blank or at the start of a row that isn't empty
    starts = np.union1d(np.flatnonzero(blank) + 1, ends[:-1][np.diff(ends) > 0])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(words), np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    place = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    terms = np.where(blank, 0, data.astype(np.uint64) + np.uint64(1)) * mixed(place)
    return mixed(np.add.reduceat(terms, starts)), np.searchsorted(starts, ends[1:]) - np.searchsorted(starts, ends[:-1])


def part_names(hashes: np.ndarray, sizes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all parts of each set, whether they are of the set's own step of size, and how many each set has.

    Similar sets lie in the same step or in neighbouring ones. At each step, sets of it and of the next meet; parts
    are as many as the largest two of these may differ in, and one. A set has the parts of its own step and of the one below.
    """
    width = -math.log(min(threshold, 0.99))
    step = np.floor(np.log(np.maximum(sizes, 1)) / width).astype(np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    blocks = []
    for own in (True, False):
        at = step if own else step - 1
        top = np.ceil(np.exp((at + 1) * width) + 1e-6)
        # sets of x and of up to x / threshold tokens that reach the threshold
        differ = np.floor((1 - threshold) / (1 + threshold) * (top + np.floor(top / threshold + 1e-6)) + 1e-6).astype(np.int64)
        # those that may not differ are one class already
        parts = np.where((differ > 0) & (sizes > 0), differ + 1, 0)
        first = np.cumsum(parts) - parts
        used = parts[of] > 0
        sums = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(sums, first[of[used]] + (hashes[used] % parts[of[used]].astype(np.uint64)).astype(np.int64), mixed(hashes[used]))
        whose = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(len(whose)) - first[whose]
        names = mixed(sums + mixed((at[whose] * (1 << 32) + number).astype(np.uint64)))
        blocks.append((whose, names, np.full(len(whose), own)))
    whose = np.concatenate([b[0] for b in blocks])
    order = np.argsort(whose, kind="stable")
    return np.concatenate([b[1] for b in blocks])[order], np.concatenate([b[2] for b in blocks])[order], np.bincount(whose, minlength=len(sizes))


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 of each number."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(threshold: float):
    """array<struct<part,own>> of a set, given its tokens joined by blanks."""

    @F.arrow_udf("array<struct<part:long,own:boolean>>")
    def of(sets: pa.Array) -> pa.Array:
        from corpusloom.operators.dedup import part_names, token_hashes  # by name: the worker's own

        pieces = []  # a byte of a text takes some tens of bytes in between
        for at in range(0, len(sets), PIECE):
            names, own, n = part_names(*token_hashes(sets.slice(at, PIECE)), threshold)
            rows = pa.StructArray.from_arrays([pa.array(names.view(np.int64)), pa.array(own)], ["part", "own"])
            pieces.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), rows))
        return pa.concat_arrays(pieces) if pieces else pa.array([], pa.list_(pa.struct([("part", pa.int64()), ("own", pa.bool_())])))

    return of


def ranked(pairs: DataFrame) -> DataFrame:
    """id, other, similarity and rank of each pair from both sides: a row's near duplicates, the most similar first."""
    sides = F.array(*[F.struct(F.col(x).alias("id"), F.col(y).alias("other")) for x, y in (("id_a", "id_b"), ("id_b", "id_a"))])
    both = pairs.select(F.explode(sides).alias("s"), "similarity").select("s.id", "s.other", "similarity")  # a union would make the pairs twice
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other")))


def _sets(docs: DataFrame, id: str, text: str, least_tokens: int) -> DataFrame:
    """id, words (the sorted tokens, joined by blanks) and n of each row whose set has the least size; a string is shuffled in a third of an array's bytes."""
    return once(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "s", token_words(F.col("text"))).select("id", "s.words", "s.n").where(F.col("n") >= least_tokens)


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """With a column that a filter may name: it isn't pushed below a generated one, where the value would be made a second time."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", least_tokens: int = 5) -> DataFrame:
    """id, tokens (sorted) and class_id, the least id with the same token set; sets below the least size are left out."""
    return class_rows(docs, id, text, least_tokens, "words").select("id", F.split("words", " ", -1).alias("tokens"), "class_id")


def class_rows(docs: DataFrame, id: str, text: str, least_tokens: int, *more: str) -> DataFrame:
    """id, n (the number of tokens), class_id and more columns of the sets; the texts of a class aren't shuffled unless asked for."""
    rows = _sets(docs, id, text, least_tokens).withColumn("key", F.unhex(F.sha2("words", 256)))
    named = rows.groupBy("key").agg(F.min("id").alias("class_id"))
    return rows.join(named, "key").select("id", "n", "class_id", *more)


def versions(inputs: DataFrame, context: str, order: list[str], text: str = "text") -> DataFrame:
    """Versions of each context: a row where the content differs from the one before, numbered from 1.

    Hashes and word counts are taken before the window, so a plan that doesn't ask for the text sorts without it.
    """
    by = Window.partitionBy(context).orderBy(*order)
    hashed = inputs.withColumn("content_hash", content_hash(F.col(text))).withColumn("_words", word_count(F.col(text))).withColumn("_before", F.lag("content_hash").over(by))
    changed = hashed.where(F.col("_before").isNull() | (F.col("_before") != F.col("content_hash"))).drop("_before")
    number = F.row_number().over(by)
    out = changed.withColumn("version_number", number).withColumn("previous_hash", F.lag("content_hash").over(by))
    previous = F.col("version_number") - 1
    out = out.withColumn("changes_summary", F.when(previous > 0, F.concat(F.lit("Updated from version "), previous.cast("string"))))
    out = out.withColumn("diff_summary", F.when(previous > 0, delta_summary(F.col("_words") - F.lag("_words").over(by))))
    return out.drop("_words")


def history(versioned: DataFrame, context: str) -> DataFrame:
    return versioned.orderBy(context, F.desc("version_number"))
