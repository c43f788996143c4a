"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits, each 1 where more than half of the text's shingle hashes have it. Two
fingerprints within ``radius`` bits meet in at least one value that lies within half the radius of both,
so every distinct fingerprint emits all values of that small ball, the values are shuffled, and the
fingerprints that meet at a value are verified and linked. Within a ball of half radius 1 at most 65
distinct fingerprints can meet, whatever the data, so no bucket is large: copies are collapsed to one
fingerprint before. A meeting emits a star, not all pairs: all who meet at a value lie within the radius
of each other when the radius is even, so a star keeps every component. Components of the distinct
fingerprints are found by label propagation with pointer jumping over checkpointed tables.

Defined results: null and empty texts and texts of white space have fingerprint zero and link like any
other; fewer words than a shingle give one shingle of all words; repeated rows share a fingerprint and a
component; an empty table gives an empty result; a null id takes part and can't name a component unless
no other id is there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, fresh, map_arrow, shuffle_partitions, utf8

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 15


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The text's SimHash as an unsigned integer."""
    found = text.translate(_LOWER).split()
    if not found:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(found) <= words:
        return digest(join(found), seed)
    n = len(found) - words + 1
    grams = map(join, zip(*(found[i:] for i in range(words))))
    hashes = np.fromiter((digest(g, seed) for g in grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _BLOCK):  # bounded whatever the text's length
        bits = np.unpackbits(hashes[start : start + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """id and fingerprint (a signed long with the same 64 bits) of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(x, words) for x in utf8(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["id", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    return map_arrow(docs, [id, text], run, f"id {kind}, fp long")


def ball(fp: F.Column, radius: int) -> F.Column:
    """All 64-bit values within ``radius`` (0 or 1) bits of a fingerprint."""
    if radius not in (0, 1):
        raise ValueError("balls of radius 0 or 1 (links at 0 to 2 bits) are supported")
    if radius == 0:
        return F.array(fp)
    masks = F.array(F.lit(0).cast("long"), *[F.lit(-(1 << 63) if b == 63 else 1 << b).cast("long") for b in range(64)])
    return F.transform(masks, lambda m: m.bitwiseXOR(fp))


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a < b) among distinct fingerprints ``fp`` that join all within ``radius`` bits of each other.

    Each edge is verified. At an even radius those meeting at a value are linked to the least of them;
    at an odd radius, where a meeting doesn't imply a link, all of a value's (at most 65) are compared.
    """
    spread = distinct.select("fp").repartition(shuffle_partitions(distinct.sparkSession))
    met = spread.select("fp", F.explode(ball(F.col("fp"), (radius + 1) // 2)).alias("value"))
    if radius % 2:
        # at most 65 members, by the geometry of the ball
        members = met.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        edges = members.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    else:
        # one shuffle: the values are sorted, and the first fingerprint of each is the others' star
        first = F.first("fp").over(Window.partitionBy("value").orderBy("fp").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        edges = met.select(first.alias("a"), F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return edges.where((F.col("a") < F.col("b")) & close).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: connected components of edges (a, b) of longs; root is the least node.

    Alternates pointer jumping with hooking every root to the least neighbouring root, so long chains take
    logarithmically many rounds. Each round's table is checkpointed; only emptiness comes to the driver.
    """
    live = checkpoint(edges.select("a", "b").where("a <> b").distinct())
    if live.isEmpty():
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    both = live.union(live.select("b", "a")).toDF("a", "b")
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    label = checkpoint(label.select("node", F.least("node", "m").alias("root")))
    while True:
        while True:
            up = label.toDF("root", "next")
            jumped = label.join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
            jumped = checkpoint(jumped)
            label = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        live = live.join(label.toDF("a", "ra"), "a").join(label.toDF("b", "rb"), "b")
        live = live.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a <> b").distinct()
        live = checkpoint(live)
        if live.isEmpty():
            return label
        hook = live.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to"))
        label = checkpoint(label.join(hook, "root", "left").select("node", F.coalesce("to", "root").alias("root")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """id, fp, root (a fingerprint of the component) and component_id (the least id reachable) of every row."""
    prints = checkpoint(fingerprints(docs, id, text))
    classes = checkpoint(prints.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(links(classes, radius))
    rooted = classes.join(found.toDF("fp", "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp", "left").select("id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """The documents, all their columns, of which each near-duplicate component keeps the one of least id.

    Ids are compared, not texts, unless an id has several rows: then the row of the least fingerprint stays,
    and one of rows that share that too. Null ids come last within a component.
    """
    found = checkpoint(near_duplicates(docs, id, text, radius))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("f"))
    chosen = first.select(F.col("f.id").alias("k_id"), F.col("f.fp").alias("k_fp"))
    rows = found.groupBy("id").agg(F.count(F.lit(1)).alias("k_rows")).withColumnRenamed("id", "r_id")
    chosen = checkpoint(chosen.join(rows, F.col("k_id").eqNullSafe(F.col("r_id"))).drop("r_id"))
    alone = chosen.where("k_rows = 1").select("k_id")
    out = docs.join(alone, docs[id].eqNullSafe(alone["k_id"]), "left_semi")
    many = chosen.where("k_rows > 1").select("k_id", "k_fp")
    if many.isEmpty():
        return out
    ids, fp = many.select("k_id").distinct(), fresh("fp", docs.columns)
    several = docs.join(ids, docs[id].eqNullSafe(ids["k_id"]), "left_semi")
    printed = _with_fingerprint(several, text, fp)
    same = printed[id].eqNullSafe(many["k_id"]) & (printed[fp] == many["k_fp"])
    kept = printed.join(many, same, "left_semi").dropDuplicates([id, fp]).select(*docs.columns)
    return out.unionByName(kept)


def _with_fingerprint(docs: DataFrame, text: str, name: str, words: int = 3) -> DataFrame:
    names, at = docs.columns, docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(x, words) for x in utf8(batch.column(at))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], [*names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, names, run, f"{fields}, `{name}` long")
