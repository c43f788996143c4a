"""Paragraph near-duplicates: MinHash banding, exact Jaccard verification, components.

What is compared (:func:`parse`), in runs of words of a document:

* near: lines of at least ``least_line`` words (by default all); where blank lines part a text, its blocks of
  several lines; sentences of at least ``least_run`` words, so that an edited passage inside a paragraph is found too;
* word for word: windows of whole sentences, each with those after it, and with those before it, until they
  have ``least_run`` words, so that of a passage that repeats every sentence is in a window that lies in it.
  Where no sentence or line ends for ``FAR`` words on either side, every fourth place, by a hash of the two
  words there, counts as an end, so passages inside long unmarked lines are found too.

Shingles are five words; near paragraphs link when the Jaccard index of their shingle sets reaches
``similarity`` (0.8). Bands and rows follow from it (:func:`tune_bands`): 6 bands of 2 at 0.8, where a pair of
0.8 collides with probability 0.998 and one of 0.9 with 0.99995. A paragraph of fewer than five words is one
shingle as a whole, so it links with its equals alone, and its name is enough. One of so few shingles that only
an equal set reaches the similarity (three at 0.8) needs one band, since equal sets have all bands in common.

1. A shard of documents names all runs by 96-bit hashes and sends each distinct name once, with its least
   document, and the band keys of near paragraphs with their names and sizes.
2. Names met twice go back to their shards with the least document of all; of band keys those where
   different texts meet whose sizes allow the similarity.
3. One shard for each text sends it to the keys where it met others; members stay where they are.
4. At a key, different texts are compared exactly: each with the members of every component so far until
   one links, so connected texts are joined without listing all pairs. More than ``CROWD`` texts at a key
   are compared through an index of prefix shingles, which is exact for the given similarity.
5. Components of the linked texts, with their sizes and earliest places, go back to the shards, which tell
   their members. The earliest paragraph of a component stays, with all that overlaps it in its document,
   and the others go. A component of which nothing goes isn't told, nor is a paragraph that stays while a
   smaller one inside it goes: what is left of it is told by its parts.

Equal texts are one node, so copies never make pairs. A key that holds more than ``HOT`` texts is divided
by prefix shingles before the shuffle, in the same exact way, so no task gets all of it. A shard sends a
name once however often it has it, so a name's traffic is bounded by the number of shards.

Defined results: null and empty texts have no paragraphs; ties go to the smaller id, null first, then the
earlier start, then the earlier end; repeated rows are documents of their own with equal places, of which
one copy of a paragraph stays; an empty table gives an empty result. Ids are integers.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, map_arrow, pack, shuffle_partitions, unpack
from .simhash import components
from .suffix import SHARD_BYTES, TARGET_BYTES, _groups, _table, _target

SHINGLE, SIMILARITY = 5, 0.8
#: Words of the least passage within a paragraph that is compared: one shingle. Paragraphs are compared whatever their length.
PASSAGE = SHINGLE
BANDS, ROWS, MINIMA, WANTED = 6, 2, 12, 0.995
HOT, CROWD = 1 << 14, 64
FAR, PLACES = 32, 4
_LOW = np.uint64(0xFFFFFFFF)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_A = _rng.integers(1, 1 << 63, MINIMA, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(1, 1 << 63, MINIMA, dtype=np.uint64)
_NONE = np.iinfo(np.int64).min
#: Texts of a key are told apart by 48 of their names' 64 bits.
_TOLD_APART = np.uint64(16)


def recall(similarity: float, bands: int, rows: int) -> float:
    return 1 - (1 - similarity**rows) ** bands


def tune_bands(similarity: float = SIMILARITY, wanted: float = WANTED, minima: int = MINIMA) -> tuple[int, int]:
    """Bands and rows with the wanted recall at the similarity: the most rows, then the fewest bands."""
    for rows in range(minima, 0, -1):
        bands = math.ceil(math.log(1 - wanted) / math.log(1 - similarity**rows)) if similarity < 1 else 1
        if bands * rows <= minima:
            return bands, rows
    raise ValueError("not with so few minima")


# -- runs of words and their names --
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * _PRIME
    return h ^ (h >> np.uint64(32))


class _Rolling:
    """Polynomial hashes of ranges of a sequence: equal content, equal hash, wherever it lies."""

    BASES = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)
    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int = 0):
        up, self.down = self._powers(self.BASES[base], len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * _PRIME)

    @classmethod
    def _powers(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        known = cls._tables.get(base)
        if known is None or len(known[0]) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            known = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
            if size <= 1 << 21:
                cls._tables[base] = known
        return known


class Words:
    """The words of texts laid end to end: where they start and end, their hashes, and what ends after each."""

    def __init__(self, texts: list[bytes], block: int = 1 << 19):
        self.data = b"\n\n".join(texts)
        sizes = np.array([len(t) + 2 for t in texts], np.int64)
        self.first = np.cumsum(sizes) - sizes  # of each text
        raw = np.frombuffer(self.data, np.uint8)
        starts, ends, hashes = [], [], []
        at, n = 0, len(raw)
        while at < n:  # bounded blocks, cut in white space
            stop = min(n, at + block)
            while stop < n and not (raw[stop] == 32 or 9 <= raw[stop] <= 13):
                space = np.flatnonzero((raw[stop : stop + block] == 32) | ((raw[stop : stop + block] >= 9) & (raw[stop : stop + block] <= 13)))
                stop = stop + int(space[0]) if len(space) else min(n, stop + block)
            part = raw[at:stop]
            solid = np.zeros(len(part) + 2, np.int8)
            solid[1:-1] = (part != 32) & ((part < 9) | (part > 13))
            edge = np.diff(solid)
            s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            hashes.append(_Rolling(part.astype(np.uint64) + np.uint64(1))(s, e))
            starts.append(s + at)
            ends.append(e + at)
            at = stop
        none = np.zeros(0, np.int64)
        self.start, self.end = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        self.hash = np.concatenate([none.astype(np.uint64), *hashes])
        self.text = np.searchsorted(self.first, self.start, side="right") - 1
        newlines = np.searchsorted(np.flatnonzero(raw == 10), self.start)
        gap = np.diff(newlines)  # a text's last word and the next one's first are two newlines apart at least
        marked = np.isin(raw[self.end[:-1] - 1], np.frombuffer(b".!?", np.uint8)) if len(self.end) else none
        last = len(self.start)
        cut = lambda x: np.concatenate([[0], np.flatnonzero(x) + 1, [last]]) if last else np.zeros(1, np.int64)
        self.lines, self.blocks, self.sentences = cut(gap > 0), cut(gap > 1), cut((gap > 0) | marked)
        self.ends = np.union1d(self.sentences, self._places())

    def _places(self) -> np.ndarray:
        """Ends by hash, far from ends of sentences."""
        n, hard = len(self.hash), self.sentences
        p = np.flatnonzero(_mix(self.hash[:-1] * np.uint64(31) ^ self.hash[1:]) % np.uint64(PLACES) == 0) + 1 if n > 1 else np.zeros(0, np.int64)
        j = np.searchsorted(hard, p)
        return p[(p - hard[j - 1] > FAR) & (hard[j] - p > FAR)] if len(p) else p

    def near(self, least_line: int, least_run: int) -> np.ndarray:
        """(first word, word after the last) of lines, blocks and sentences that are compared by bands."""
        found = []
        lines = np.stack([self.lines[:-1], self.lines[1:]], axis=1)
        found.append(lines[lines[:, 1] - lines[:, 0] >= least_line])
        blocks = np.stack([self.blocks[:-1], self.blocks[1:]], axis=1)
        several = np.searchsorted(self.lines, blocks[:, 1]) - np.searchsorted(self.lines, blocks[:, 0]) > 1
        of = self.text[blocks[:, 0]]
        alone = np.bincount(of, minlength=len(self.first))[of] == 1 if len(of) else several
        found.append(blocks[several & ~alone & (blocks[:, 1] - blocks[:, 0] >= least_line)])
        sentences = np.stack([self.sentences[:-1], self.sentences[1:]], axis=1)
        found.append(sentences[sentences[:, 1] - sentences[:, 0] >= max(SHINGLE, least_run)])
        return np.concatenate(found)

    def windows(self, least_run: int) -> np.ndarray:
        """(first word, word after the last) of windows of sentences that are compared word for word."""
        e = self.ends
        after = np.searchsorted(e, e[:-1] + least_run)
        ok = after < len(e)
        forward = np.stack([e[:-1][ok], e[after[ok]]], axis=1)
        before = np.searchsorted(e, e[1:] - least_run, side="right") - 1
        ok = before >= 0
        backward = np.stack([e[before[ok]], e[1:][ok]], axis=1)
        both = np.concatenate([forward, backward])
        return both[self.text[both[:, 0]] == self.text[both[:, 1] - 1]] if len(both) else both

    def normal(self, a: int, b: int) -> bytes:
        """The words of a run, joined by single spaces."""
        return b" ".join(self.data[self.start[a] : self.end[b - 1]].split())


def shingles(words: list[bytes]) -> np.ndarray:
    """A hash for each run of ``SHINGLE`` words, made of the words' hashes."""
    return _shingles(np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64))


def _shingles(each: np.ndarray) -> np.ndarray:
    n = max(0, len(each) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = (out ^ each[k : k + n]) * _PRIME
        out ^= out >> np.uint64(29)
    return out


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if both else 0.0


def band_keys(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, bands: int = BANDS, rows: int = ROWS, block: int = 1 << 16) -> np.ndarray:
    """(ranges, bands) of 64-bit keys of ranges of shingles."""
    keys = np.zeros((len(starts), bands), np.uint64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    at = 0
    while at < len(starts):  # bounded stretches of shingles
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + block)))
        low, high = int(starts[at]), int(ends[at:stop].max())
        part = hashes[low:high]
        ranges = np.stack([starts[at:stop] - low, ends[at:stop] - low], axis=1).ravel()
        for band in range(bands):
            key = np.full(stop - at, band, np.uint64)
            for k in range(band * rows, band * rows + rows):
                mixed = part * _A[k] + _B[k]
                mixed ^= mixed >> np.uint64(29)
                key = (key ^ np.minimum.reduceat(np.append(mixed, _LOW), ranges)[::2]) * _PRIME
                key ^= key >> np.uint64(31)
            keys[order[at:stop], band] = key
        at = stop
    return keys


def prefix(hashes: set[int], similarity: float = SIMILARITY) -> list[int]:
    """Shingles of which two sets that similar share one at least: the least of each, in one order for all."""
    return sorted(hashes)[: len(hashes) - math.ceil(similarity * len(hashes)) + 1]


def linked(sets: list[set[int]], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Edges that connect all sets connected by pairs of that similarity; each edge is verified."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges, index = [], defaultdict(list)
    crowd = len(sets) > CROWD
    for i, mine in enumerate(sets):
        if crowd:
            near = sorted({j for h in prefix(mine, similarity) for j in index[h]})
            for h in prefix(mine, similarity):
                index[h].append(i)
        else:
            near = range(i)
        for j in near:
            if find(j) != find(i) and min(len(mine), len(sets[j])) >= similarity * max(len(mine), len(sets[j])) and jaccard(mine, sets[j]) >= similarity:
                root[find(i)] = find(j)
                edges.append((j, i))
    return edges


# -- the passes --
def _packed(rows: DataFrame) -> DataFrame:
    """The texts compressed, one by one, for the shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        small = zstandard.ZstdCompressor(3)
        data = [None if x is None else small.compress(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary()), batch.column(2)], ["doc_id", "text", "shard"])

    return map_arrow(rows, ["doc_id", "text", "shard"], run, "doc_id long, text binary, shard long")


class _Shard:
    """All runs of a shard's documents, in order of the documents, and its distinct names in order."""

    def __init__(self, table: pa.Table, least_line: int, least_run: int):
        ids = table.column("doc_id").to_pylist()
        whole = zstandard.ZstdDecompressor()
        texts = [b"" if x is None else whole.decompress(x) for x in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.ids = np.array([_NONE if ids[i] is None else ids[i] for i in order], np.int64)
        same = np.flatnonzero(np.r_[True, self.ids[1:] != self.ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
        self.copies = np.arange(len(ids)) - np.repeat(same, np.diff(np.r_[same, len(ids)]))
        self.words = words = Words([texts[i] for i in order])
        near = words.near(least_line, least_run)
        runs = np.concatenate([near, words.windows(least_run)])
        width = np.int64(len(words.hash) + 1)
        keys, first = np.unique(runs[:, 0] * width + runs[:, 1], return_index=True)  # in order of place
        self.a, self.b = keys // width, keys % width
        near = near[near[:, 1] - near[:, 0] >= SHINGLE]
        self.banded = np.isin(keys, near[:, 0] * width + near[:, 1])
        one, two = _Rolling(words.hash), _Rolling(words.hash, 1)
        self.name = one(self.a, self.b)
        self.names, self.lead, self.which, self.count = np.unique(self.name, return_index=True, return_inverse=True, return_counts=True)
        self.more = (two(self.a[self.lead], self.b[self.lead]) >> np.uint64(32)).astype(np.uint32)
        self.of = words.text[self.a] if len(self.a) else np.zeros(0, np.int64)

    def places(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes at which runs start and end in their documents."""
        begin = self.words.first[self.of[runs]]
        return self.words.start[self.a[runs]] - begin, self.words.end[self.b[runs] - 1] - begin


def _steps(ordered: np.ndarray) -> np.ndarray:
    """A sorted array as differences, which :func:`np.cumsum` undoes."""
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def _hex(name: int, more: int) -> str:
    return f"{name:016x}{more:08x}"


def _distinct(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many different shingles each range has."""
    by = np.argsort(starts, kind="stable")  # between ranges in order there are no long gaps, which would be read too
    starts, ends = starts[by], ends[by]
    sizes = ends - starts
    if not len(starts):
        return sizes
    order = np.argsort(hashes, kind="stable")
    again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    before = np.full(len(hashes) + 1, -1)  # where the same shingle was last
    before[order[again + 1]] = order[again]
    repeats = np.maximum.reduceat(before, np.stack([starts, ends], axis=1).ravel())[::2] >= starts
    for i in np.flatnonzero(repeats).tolist():
        sizes[i] = np.count_nonzero(before[starts[i] : ends[i]] < starts[i])
    out = np.empty_like(sizes)
    out[by] = sizes
    return out


def _level(sizes: np.ndarray) -> np.ndarray:
    """Sizes by steps of a hundredth, so that two bytes hold them."""
    return np.floor(np.log(np.maximum(sizes, 1)) * 100).astype(np.uint16)


_SURVEY = pa.schema([("target", pa.int64()), ("shard", pa.int64()), ("names", pa.binary()), ("more", pa.binary()), ("ids", pa.binary()), ("many", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()), ("owners", pa.binary()), ("levels", pa.binary())])


def _survey(targets: int, least_line: int, least_run: int, bands: int, rows: int, similarity: float):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        found = _Shard(table, least_line, least_run)
        if not len(found.names):
            return _table([], _SURVEY)
        # runs are in order of the documents, so the first run of a name has its least document
        ids = found.ids[found.of[found.lead]]
        banded = np.unique(found.which[found.banded])
        a, b = found.a[found.lead[banded]], found.b[found.lead[banded]]
        hashes, last = _shingles(found.words.hash), b - SHINGLE + 1
        sizes = _distinct(hashes, a, last)
        few = sizes < similarity * (sizes + 1)  # only an equal set is that similar, and it has each band's key
        use = np.broadcast_to(~few[:, None] | (np.arange(bands) == 0), (len(a), bands))
        keys = band_keys(hashes, a, last, bands, rows)[use]
        owners, levels = np.repeat(found.names[banded] >> _TOLD_APART, use.sum(axis=1)), np.repeat(_level(sizes), use.sum(axis=1))
        # of a text's equal keys one is enough, and its bands differ by construction
        at_names, at_keys = dict(_groups(_target(found.names, targets))), dict(_groups(_target(keys, targets)))
        none = np.zeros(0, np.int64)
        out = []
        for t in sorted({*at_names, *at_keys}):
            m, k = at_names.get(t, none), at_keys.get(t, none)
            k = k[np.argsort(keys[k] & _LOW)]
            often = np.flatnonzero(found.count[m] > 1)
            columns = [
                _steps(found.names[m]), found.more[m], ids[m], often.astype(np.uint32), found.count[m][often].astype(np.uint32),
                _steps((keys[k] & _LOW).astype(np.uint32)), owners[k], levels[k],
            ]
            out.append((t, shard, *map(pack, columns)))
        return _table(out, _SURVEY)

    return run, "target long, shard long, names binary, more binary, ids binary, many binary, counts binary, keys binary, owners binary, levels binary"


#: What is said of a key: different texts meet there; more than HOT of them do.
_MET, _CROWDED = 1, 2
_SHARED = pa.schema([("shard", pa.int64()), ("target", pa.int64()), ("names", pa.binary()), ("firsts", pa.binary()), ("totals", pa.binary()), ("apart", pa.binary()), ("keys", pa.binary()), ("owners", pa.binary()), ("kinds", pa.binary())])


def _all(table: pa.Table, column: str, kind, steps: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A packed column's values in all rows, and how many each row has."""
    parts = [unpack(x, kind) for x in table.column(column).to_pylist()]
    parts = [np.cumsum(p, dtype=kind) for p in parts] if steps else parts
    return np.concatenate([np.zeros(0, kind), *parts]), np.array([len(p) for p in parts], np.int64)


def _shared(hot: int, similarity: float):
    slack = math.ceil(-100 * math.log(similarity)) + 1

    def run(table: pa.Table) -> pa.Table:
        target = table.column("target")[0].as_py()
        shards = np.array(table.column("shard").to_pylist(), np.int64)
        names, sizes = _all(table, "names", np.uint64, steps=True)
        more, ids, owner = _all(table, "more", np.uint32)[0], _all(table, "ids", np.int64)[0], np.repeat(shards, sizes)
        count = np.ones(len(names), np.int64)
        many, per = _all(table, "many", np.uint32)
        count[many + np.repeat(np.cumsum(sizes) - sizes, per)] = _all(table, "counts", np.uint32)[0]
        order = np.lexsort((ids, more, names))
        names, more, ids, owner, count = names[order], more[order], ids[order], owner[order], count[order]
        begin = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (more[1:] != more[:-1])]) if len(names) else np.zeros(0, np.int64)
        size = np.diff(np.r_[begin, len(names)])
        total = np.add.reduceat(count, begin) if len(begin) else begin
        spread = (ids[begin] != ids[begin + size - 1]).astype(np.uint8) if len(begin) else begin.astype(np.uint8)
        often = np.repeat(total > 1, size)
        first, total, spread = (np.repeat(x, size)[often] for x in (ids[begin], total, spread))
        names, owner = names[often], owner[often]
        by_shard = dict(_groups(owner))

        keys, per = _all(table, "keys", np.uint32, steps=True)
        text, level = _all(table, "owners", np.uint64)[0], _all(table, "levels", np.uint16)[0].astype(np.int64)
        sender = np.repeat(shards, per)
        order = np.lexsort((sender, text, level, keys))
        keys, text, level, sender = keys[order], text[order], level[order], sender[order]
        # one shard speaks for each text at a key, the least that has it
        lead = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])]) if len(keys) else np.zeros(0, np.int64)
        keys, text, level, sender = keys[lead], text[lead], level[lead], sender[lead]
        close = (keys[1:] == keys[:-1]) & (np.diff(level) <= slack)
        kind = (np.r_[False, close] | np.r_[close, False]).astype(np.uint8)[: len(keys)]
        _, inverse, different = np.unique(keys, return_inverse=True, return_counts=True)
        kind = np.where((kind > 0) & (different[inverse] > hot), _CROWDED, kind).astype(np.uint8) if len(keys) else kind
        met = np.flatnonzero(kind)
        keys, text, sender, kind = keys[met], text[met], sender[met], kind[met]
        keys_by_shard = dict(_groups(sender))
        none = np.zeros(0, np.int64)
        out = []
        for shard in sorted({*by_shard, *keys_by_shard}):
            m, k = by_shard.get(shard, none), keys_by_shard.get(shard, none)
            out.append((shard, target, *map(pack, (_steps(names[m]), first[m], total[m].astype(np.int64), spread[m], keys[k], text[k], kind[k]))))
        return _table(out, _SHARED)

    return run, "shard long, target long, names binary, firsts binary, totals binary, apart binary, keys binary, owners binary, kinds binary"


#: Of each shard: rows of texts for a target, packed; what the shard has of near paragraphs (``name`` is filled);
#: and one row of all its members of repeated texts, packed.
_SENT = pa.schema([
    ("shard", pa.int64()), ("target", pa.int64()), ("texts", pa.binary()), ("name", pa.string()), ("about", pa.struct([(c, pa.int64()) for c in ("n", "first_id", "first_copy", "first_start", "first_end", "last_id", "last_copy", "last_start")])),
    ("members", pa.binary()), ("units", pa.binary()),
])
_SENT_SQL = (
    "shard long, target long, texts binary, name string, about struct<n:long,first_id:long,first_copy:long,first_start:long,first_end:long,last_id:long,last_copy:long,last_start:long>, members binary, units binary"
)
_MEMBER = np.dtype([("id", "<i8"), ("copy", "<u4"), ("start", "<u4"), ("end", "<u4"), ("words", "<u4"), ("unit", "<u4")])
_UNIT = np.dtype([("name", "<u8"), ("more", "<u4"), ("total", "<u4"), ("first", "<i8"), ("apart", "u1")])


def _send(targets: int, least_line: int, least_run: int, similarity: float):
    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return _table([], _SENT)
        shard = docs.column("shard")[0].as_py()
        found = _Shard(docs, least_line, least_run)
        n = len(found.names)
        total, first, apart = np.zeros(n, np.int64), np.full(n, _NONE), np.zeros(n, np.uint8)
        names, _ = _all(shared, "names", np.uint64, steps=True)
        at = np.searchsorted(found.names, names)
        total[at], first[at], apart[at] = _all(shared, "totals", np.int64)[0], _all(shared, "firsts", np.int64)[0], _all(shared, "apart", np.uint8)[0]
        keys, per = _all(shared, "keys", np.uint32)
        key = np.repeat(np.array(shared.column("target").to_pylist(), np.int64), per) << 32 | keys.astype(np.int64)
        near = np.unique(found.which[found.banded])
        known, owners = found.names[near] >> _TOLD_APART, _all(shared, "owners", np.uint64)[0]
        at = np.searchsorted(known, owners)
        many = np.searchsorted(known, owners, side="right") - at  # texts of one short name all speak
        speaks = near[np.repeat(at - np.cumsum(many) + many, many) + np.arange(many.sum())]
        key, kinds = np.repeat(key, many), np.repeat(_all(shared, "kinds", np.uint8)[0], many)
        out: list[tuple] = []
        texts: dict[int, bytes] = {}
        sent: dict[int, list[tuple[int, int]]] = defaultdict(list)  # target: keys and texts
        for i, k, kind in zip(speaks.tolist(), key.tolist(), kinds.tolist()):
            if i not in texts:
                texts[i] = found.words.normal(int(found.a[found.lead[i]]), int(found.b[found.lead[i]]))
            if kind == _MET:
                sent[k >> 32].append((k, i))
                continue
            for h in prefix(set(shingles(texts[i].split(b" ")).tolist()), similarity):
                own = xxhash.xxh64_intdigest(k.to_bytes(8, "little") + h.to_bytes(8, "little"))
                sent[(own >> 32) * targets >> 32].append((own >> 1, i))
        label = lambda i: _hex(int(found.names[i]), int(found.more[i]))
        for t, pairs in sorted(sent.items()):
            own = sorted({i for _, i in pairs})
            place = {i: p for p, i in enumerate(own)}
            data = pickle.dumps(([label(i) for i in own], [texts[i] for i in own], [(k, place[i]) for k, i in pairs]))
            out.append((shard, t, zstandard.compress(data, 3), *(None,) * 4))
        # a text that another shard speaks for is repeated, so it is told here as well
        told = total > 1
        told[speaks] = True
        runs = np.flatnonzero(told[found.which])
        if not len(runs):
            return _table(out, _SENT)
        start, end = found.places(runs)
        number = np.cumsum(told) - 1
        members = np.zeros(len(runs), _MEMBER)
        members["id"], members["copy"], members["start"], members["end"] = found.ids[found.of[runs]], found.copies[found.of[runs]], start, end
        members["words"], members["unit"] = found.b[runs] - found.a[runs], number[found.which[runs]]
        kept = np.flatnonzero(told)
        units = np.zeros(len(kept), _UNIT)
        units["name"], units["more"], units["total"], units["first"], units["apart"] = found.names[kept], found.more[kept], total[kept], first[kept], apart[kept]
        # what the components need of near paragraphs: any of them may be linked
        near = np.isin(kept, np.unique(found.which[found.banded]))
        order = np.argsort(members["unit"], kind="stable")
        begin = np.flatnonzero(np.r_[True, np.diff(members["unit"][order]) != 0])
        for u, group in enumerate(np.split(order, begin[1:])):
            if near[u]:
                m, first_, last_ = members[group], members[group[0]], members[group[-1]]
                places = (first_["id"], first_["copy"], first_["start"], first_["end"], last_["id"], m["copy"].max(), m["start"].max())
                names = ("first_id", "first_copy", "first_start", "first_end", "last_id", "last_copy", "last_start")
                out.append((shard, None, None, label(int(kept[u])), {"n": len(m)} | dict(zip(names, map(int, places))), None, None))
        members["start"], members["end"] = _steps(members["start"]), members["end"] - members["start"]
        out.append((shard, *(None,) * 4, pack(members), pack(units)))
        return _table(out, _SENT)

    return run, _SENT_SQL


def _verify(similarity: float):
    """Edges between texts at each key of a target."""
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])

    def run(table: pa.Table) -> pa.Table:
        at_key: dict[int, dict[str, bytes]] = defaultdict(dict)
        for data in table.column("texts").to_pylist():
            names, texts, pairs = pickle.loads(zstandard.decompress(data))
            for key, i in pairs:
                at_key[key][names[i]] = texts[i]
        edges = set()
        sets: dict[str, set[int]] = {}
        for here in at_key.values():
            names = sorted(here)
            for n in names:
                if n not in sets:
                    sets[n] = set(shingles(here[n].split(b" ")).tolist())
            edges.update((names[i], names[j]) for i, j in linked([sets[n] for n in names], similarity))
        found = sorted(edges)
        return pa.table([pa.array([e[k] for e in found], pa.string()) for k in (0, 1)], schema=schema)

    return run, "a string, b string"


_TOLD = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("component_id", pa.string()), ("component_size", pa.int64()), ("kept_doc_id", pa.int64()), ("removed", pa.bool_()), ("end", pa.int64())])


def _finish():
    def run(packed: pa.Table, comps: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return _TOLD.empty_table()
        m, u = unpack(packed.column("members")[0].as_py(), _MEMBER), unpack(packed.column("units")[0].as_py(), _UNIT)
        start = np.cumsum(m["start"], dtype=np.uint32).astype(np.int64)
        end, unit = start + m["end"], m["unit"].astype(np.int64)
        order = np.argsort(unit, kind="stable")  # members are in order of place
        begin = np.flatnonzero(np.r_[True, np.diff(unit[order]) != 0])
        lead, last = order[begin], order[np.r_[begin[1:] - 1, len(order) - 1]]
        here = m["id"][lead] == u["first"]
        size, f_id, f_copy = u["total"].astype(np.int64), u["first"].copy(), np.where(here, m["copy"][lead], 0).astype(np.int64)
        f_end = np.where(here, end[lead], -1)
        apart = (u["apart"] > 0) | (m["id"][lead] != m["id"][last]) | (m["copy"][lead] != m["copy"][last])
        latest = np.maximum.reduceat(start[order], begin)
        named = [_hex(n, k) for n, k in zip(u["name"].tolist(), u["more"].tolist())]
        if comps.num_rows:
            number = {n: i for i, n in enumerate(named)}
            for name, root, n, i, copy, stop, is_apart, at in zip(*(comps.column(c).to_pylist() for c in ("name", "root", "size", "f_id", "f_copy", "f_end", "apart", "latest"))):
                if (k := number.get(name)) is not None:
                    named[k], size[k], f_id[k], f_copy[k], f_end[k], apart[k], latest[k] = root, n, i, copy, stop, is_apart, at
        told = (size > 1) & (apart | (latest >= f_end))
        rows = np.flatnonzero(told[unit])
        m, start, end, unit = m[rows], start[rows], end[rows], unit[rows]
        removed = ~((m["id"] == f_id[unit]) & (m["copy"] == f_copy[unit]) & (start < f_end[unit]))
        # a paragraph that stays while a smaller one inside it goes isn't told
        doc = np.cumsum(np.r_[False, (m["id"][1:] != m["id"][:-1]) | (m["copy"][1:] != m["copy"][:-1])]) if len(m) else start
        least = np.where(removed, end, np.iinfo(np.int64).max)
        # least end of what goes and starts here or later in the document: documents are kept apart by an offset
        span = np.int64(1) << 33
        far = np.where(removed, end, span - 1) + doc * span
        later = np.minimum.accumulate(far[::-1])[::-1] - doc * span if len(m) else least
        at = np.searchsorted(doc * span + start, doc * span + start) if len(m) else start
        keep = removed | ~(later[at] <= end) if len(m) else removed
        rows = np.flatnonzero(keep)
        m, start, end, unit, removed = m[rows], start[rows], end[rows], unit[rows], removed[rows]
        ids = lambda x: pa.array(x, pa.int64(), mask=x == _NONE)
        return pa.table(
            [ids(m["id"].copy()), pa.array(start), pa.array(m["words"].astype(np.int64)), pa.array([named[k] for k in unit.tolist()], pa.string()), pa.array(size[unit]), ids(f_id[unit]), pa.array(removed), pa.array(end)],
            schema=_TOLD,
        )

    return run, "doc_id long, start long, n_words long, component_id string, component_size long, kept_doc_id long, removed boolean, end long"


def duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, hot: int = HOT, least_line: int = 1, least_run: int = PASSAGE
) -> DataFrame:
    """doc_id, start, n_words, component_id, component_size, kept_doc_id, removed and end of each repeated paragraph.

    ``component_id`` names the paragraph's component, ``kept_doc_id`` the document whose paragraph stays;
    ``start`` and ``end`` are the bytes at which the paragraph starts and ends. Paragraphs may overlap: a line
    and its sentences are told each; what goes is the union of all removed places. ``least_line`` and
    ``least_run`` are the words that a line or block, and a passage within, have at least.
    """
    if least_line < 1:
        raise ValueError("a line has a word at least")
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parts = shuffle_partitions(docs.sparkSession)
    shards, targets = max(parts, -(-total // SHARD_BYTES)), max(parts, -(-total // TARGET_BYTES))
    bands, minima = tune_bands(similarity)
    sharded = _packed(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("long")))
    survey = sharded.groupBy("shard").applyInArrow(*_survey(targets, least_line, least_run, bands, minima, similarity))
    shared = survey.groupBy("target").applyInArrow(*_shared(hot, similarity))
    sent = checkpoint(sharded.groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(*_send(targets, least_line, least_run, similarity)))
    texts = sent.where("texts is not null").select("target", "texts")
    roots = components(checkpoint(texts.groupBy("target").applyInArrow(*_verify(similarity))))
    about = sent.where("name is not null").select("shard", "name", "about.*").join(roots.toDF("name", "root"), "name")
    whole = about.groupBy("root").agg(
        F.sum("n").alias("size"), F.min(F.struct("first_id", "first_start", "first_end", "first_copy")).alias("f"),
        ((F.min("first_id") != F.max("last_id")) | (F.min("first_copy") != F.max("last_copy"))).alias("apart"), F.max("last_start").alias("latest"),
    )
    told = about.select("shard", "name", "root").join(whole, "root")
    told = told.select("shard", "name", "root", "size", F.col("f.first_id").alias("f_id"), F.col("f.first_copy").alias("f_copy"), F.col("f.first_end").alias("f_end"), "apart", "latest")
    members = sent.where("members is not null").select(F.col("shard").alias("of_shard"), "members", "units")
    return members.groupBy("of_shard").cogroup(told.groupBy("shard")).applyInArrow(*_finish())


def removals(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, how many repeated paragraphs it loses and their places, for documents that lose any."""
    gone = duplicates(docs, id, text, **options).where("removed")
    return gone.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_removed"), F.sort_array(F.collect_list("start")).alias("starts"))
