"""Exact substring deduplication by suffix arrays.

A byte goes where a string of ``length`` (100) bytes covers it that also starts earlier: in a smaller id,
or in the same document at an earlier start. Texts are divided into shards by a hash of the id.

1. Each window of 100 bytes is named by its anchor, the least hashed 32-byte gram in it (a minimizer), so
   equal windows have equal anchors wherever they lie. A shard sends each of its distinct anchors once.
2. Anchors found twice go back to the shards that have them; no window of another anchor can repeat.
3. A shard cuts, for each such anchor, the fragment of its text that holds the anchor's windows, drops
   fragments that an earlier one in the shard equals byte by byte, and sends the rest to the anchor's shard.
4. There, equal fragments collapse into the earliest, and fragments that differ make suffix arrays: blocks
   of bounded size, sorted by Larsson-Sadakane refinement in numpy, with Kasai's common prefixes. Neighbours
   with a common prefix of 100 or more are equal windows; all but the earliest go. An anchor that runs over
   several blocks has its windows looked up in the earlier blocks' arrays by binary search.
5. The removed runs go back to the shard of the text, which joins them and hashes what is left.

An anchor met more than ``HOT`` times (a passage that a third of all rows holds, in other words every
time) is cut into single windows, which are routed by their own hash and collapse at both ends, so no
task holds all of one anchor. Shards are about ``SHARD_BYTES`` each whatever the size of the input.

Defined results: null text is empty; null ids come first; rows of the same id and text are one document,
reported for each row; rows of the same id and different texts are documents in the order of their texts;
a text shorter than 100 bytes is kept; an empty table gives an empty result. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, pack, shuffle_partitions, unpack

LENGTH, GRAM = 100, 32
HOT = 1 << 14
SHARD_BYTES = 4 << 20
#: Anchors are counted by fewer and larger targets than there are shards, so that what a shard sends to one stays long.
TARGET_BYTES = 8 * SHARD_BYTES
_CHUNK = 1 << 17
_BLOCK = 1 << 19
_MASK = np.uint64((1 << 20) - 1)


def _random_table() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(bytes([b]), 7) | 1 for b in range(256)], np.uint64)


_BYTES = _random_table()
_FACTORS = [np.uint64(xxhash.xxh64_intdigest(b"factor%d" % k, 7) | 1) for k in range(5)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


# -- suffix arrays --
def suffix_array(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of fragments laid end to end, by Larsson-Sadakane refinement.

    ``ends[i]`` is the end of position i's fragment; a suffix ends there, and a suffix that is another's
    beginning comes first, equal ones in order of position. Groups of equal prefixes of h bytes are split by
    the ranks h further on, which doubles h; groups of one are left alone from then on.
    """
    n = len(text)
    head = packed(text, ends)
    sa = np.argsort(head)
    ordered = head[sa]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    sizes = np.diff(np.r_[starts, n])
    rank[sa] = np.repeat(starts, sizes)  # a group's rank is its first place
    wide = sizes > 1
    place = _ranges(starts[wide], sizes[wide])  # places in the array that aren't settled
    h = 8
    while len(place):
        at = sa[place]
        group = rank[at]
        beyond = at + h
        over = beyond >= ends[at]
        # suffixes that end within these 2 h bytes come first, by length and then by position
        rest = np.where(over, ends[at] - at, 0)
        width, span = n.bit_length(), (2 * h).bit_length()
        if 2 * width + span + 1 > 63:
            key = np.where(over, (rest << width) + at, ((h + 1) << width) + rank[np.where(over, 0, beyond)])
            order = np.lexsort((key, group))
        else:
            key = np.where(over, (rest << width) | at, ((h + 1) << width) + rank[np.where(over, 0, beyond)])
            order = np.argsort(group << (width + span + 1) | key)
        at, group, key = at[order], group[order], key[order]
        sa[place] = at
        first = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
        begins = np.flatnonzero(first)
        sizes = np.diff(np.r_[begins, len(at)])
        rank[at] = np.repeat(place[begins], sizes)
        place = place[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa, rank


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.cumsum(sizes) - sizes
    return np.repeat(starts - offsets, sizes) + np.arange(int(sizes.sum()))


def packed(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number, zeros beyond the fragment's end."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(n, np.uint64)
    left = ends - np.arange(n)
    for k in range(8):
        byte = padded[k : k + n].astype(np.uint64)
        byte[left <= k] = 0
        out = out << np.uint64(8) | byte
    return out


def common_prefixes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Kasai's lengths of the common prefix of each suffix and the one before it in the array.

    All fragments advance together, one position at a time: a lane is a fragment, and each lane's length
    falls by one at most when its position moves by one, which is Kasai's argument.
    """
    n = len(text)
    lcp = np.zeros(n, np.int64)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    padded = np.concatenate([text, np.zeros(1, np.uint8)])
    stop = ends[starts]
    lanes = np.argsort(starts - stop, kind="stable")  # longest first
    at, stop = starts[lanes].copy(), stop[lanes]
    height = np.zeros(len(at), np.int64)
    while len(at):
        live = np.searchsorted(-(stop - at), 0, side="left")  # lengths stay in order: all shrink by one
        at, stop, height = at[:live], stop[:live], height[:live]
        if not live:
            break
        other = before[at]
        most = np.where(other < 0, 0, np.minimum(stop - at, ends[np.maximum(other, 0)] - other))
        height = np.minimum(height, most)
        run = np.flatnonzero(height < most)
        while len(run):
            same = padded[at[run] + height[run]] == padded[other[run] + height[run]]
            run = run[same]
            height[run] += 1
            run = run[height[run] < most[run]]
        lcp[rank[at]] = height
        at = at + 1
        height = np.maximum(height - 1, 0)
    return lcp


class Block:
    """A suffix array over fragments: which windows an earlier one equals, and look-up by binary search."""

    def __init__(self, fragments: list[bytes], length: int = LENGTH):
        self.length = length
        self.text = np.frombuffer(b"".join(fragments), np.uint8)
        sizes = np.array([len(f) for f in fragments], np.int64)
        stops = np.cumsum(sizes)
        self.starts = stops - sizes
        self.ends = np.repeat(stops, sizes)
        self.fragment = np.repeat(np.arange(len(fragments)), sizes)
        self.head = packed(self.text, self.ends)
        sa, rank = suffix_array(self.text, self.ends)
        lcp = common_prefixes(self.text, self.starts, self.ends, sa, rank)
        whole = self.ends[sa] - sa >= length
        # classes of equal windows: neighbours in the array; the least position is the earliest window
        klass = np.cumsum(lcp < length) - 1
        least = np.minimum.reduceat(sa, np.flatnonzero(np.r_[True, lcp[1:] < length]))
        self.repeated = np.zeros(len(sa), bool)
        self.repeated[sa] = whole & (least[klass] != sa)
        self.sorted = sa[whole]

    def windows(self, fragments: np.ndarray) -> np.ndarray:
        """Positions of the whole windows that lie in the marked fragments."""
        at = np.flatnonzero(fragments[self.fragment])
        return at[self.ends[at] - at >= self.length]

    def holds(self, other: Block, at: np.ndarray) -> np.ndarray:
        """Which windows of another block, at the given positions, this block has too."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.sorted), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            less = self._compare(self.sorted[middle], other, at[open_]) < 0
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        found = np.zeros(len(at), bool)
        inside = np.flatnonzero(low < len(self.sorted))
        found[inside] = self._compare(self.sorted[low[inside]], other, at[inside]) == 0
        return found

    def _compare(self, mine: np.ndarray, other: Block, theirs: np.ndarray) -> np.ndarray:
        result = np.zeros(len(mine), np.int8)
        open_ = np.arange(len(mine))
        for k in [*range(0, self.length - 8, 8), self.length - 8]:
            a, b = self.head[mine[open_] + k], other.head[theirs[open_] + k]
            result[open_] = (a > b).astype(np.int8) - (a < b).astype(np.int8)
            open_ = open_[a == b]
            if not len(open_):
                break
        return result


# -- anchors --
def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows that share their anchor: text number, first start, number of windows, hash."""
    found: list[tuple[np.ndarray, ...]] = []
    pieces: list[tuple[int, int, bytes]] = []
    held = 0
    for i, text in enumerate(texts):
        for base in range(0, len(text) - length + 1, _CHUNK):
            piece = text[base : base + _CHUNK + length - 1]
            if held and held + len(piece) > _CHUNK:
                found.append(_anchors(pieces, length, gram))
                pieces, held = [], 0
            pieces.append((i, base, piece))
            held += len(piece)
    if pieces:
        found.append(_anchors(pieces, length, gram))
    names, kinds = ("text", "start", "count", "hash"), (np.int64, np.int64, np.int64, np.uint64)
    return {n: np.concatenate([f[j] for f in found]) if found else np.zeros(0, k) for j, (n, k) in enumerate(zip(names, kinds))}


def _anchors(pieces: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    n = len(data)
    h, k = _BYTES[data], 1
    for factor in _FACTORS:
        if k >= gram:
            break
        h = h[:-k] * factor + h[k:]
        k *= 2
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    key = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
    width, k, least = length - gram + 1, 1, key
    while 2 * k <= width:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    if k < width:
        least = np.minimum(least[: len(least) - (width - k)], least[width - k :])
    sizes = np.array([len(p) for _, _, p in pieces])
    stops = np.cumsum(sizes)
    which = np.repeat(np.arange(len(pieces)), np.maximum(sizes - length + 1, 0))
    first = stops - sizes
    inside = np.arange(len(which)) - np.repeat(np.cumsum(sizes - length + 1) - (sizes - length + 1), sizes - length + 1)
    at = first[which] + inside  # windows that lie within one text
    place = (least[at] & _MASK).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (which[1:] != which[:-1])])
    count = np.diff(np.r_[cut, len(at)])
    number = np.array([i for i, _, _ in pieces], np.int64)
    base = np.array([b for _, b, _ in pieces], np.int64)
    # least hashes are small numbers; mixed again they spread evenly over the targets
    name = h[place[cut]] * _MIX
    name ^= name >> np.uint64(31)
    name *= _FACTORS[0]
    return number[which[cut]], base[which[cut]] + inside[cut], count.astype(np.int64), name ^ (name >> np.uint64(30))


def _target(hashes: np.ndarray, targets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(targets) >> np.uint64(32)).astype(np.int64)


_LOW = np.uint64(0xFFFFFFFF)


# -- the passes --
def _rows(table: pa.Table) -> tuple[list, list[bytes], list[int]]:
    """Distinct (id, text) of a shard in order, and how often each is there."""
    ids = table.column("doc_id").to_pylist()
    texts = [x or b"" for x in table.column("text").cast(pa.binary()).to_pylist()]
    counts: dict[tuple, int] = {}
    for row in zip(ids, texts):
        counts[row] = counts.get(row, 0) + 1
    order = sorted(counts, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return [r[0] for r in order], [r[1] for r in order], [counts[r] for r in order]


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    for members in np.split(order, cut[1:]):
        yield int(keys[members[0]]), members


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _survey(targets: int):
    schema = pa.schema([("target", pa.int64()), ("shard", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        _, texts, _ = _rows(table)
        hashes, counts = np.unique(anchors(texts)["hash"], return_counts=True)
        low, counts = (hashes & _LOW).astype(np.uint32), counts.astype(np.uint32)
        rows = [(t, shard, low[m].tobytes(), pack(counts[m])) for t, m in _groups(_target(hashes, targets))]
        return _table(rows, schema)

    return run, "target long, shard long, hashes binary, counts binary"


def _shared(hot: int):
    schema = pa.schema([("shard", pa.int64()), ("target", pa.int64()), ("hashes", pa.binary()), ("hot", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        target = table.column("target")[0].as_py()
        shards = np.array(table.column("shard").to_pylist(), np.int64)
        parts = [np.frombuffer(x, np.uint32) for x in table.column("hashes").to_pylist()]
        counts = np.concatenate([unpack(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        hashes, owner = np.concatenate(parts), np.repeat(shards, [len(p) for p in parts])
        _, inverse = np.unique(hashes, return_inverse=True)
        total = np.bincount(inverse, weights=counts)[inverse]
        often = np.flatnonzero(total > 1)
        rows = []
        for shard, m in _groups(owner[often]):
            at = often[m]
            rows.append((shard, target, hashes[at].tobytes(), (total[at] > hot).astype(np.uint8).tobytes()))
        return _table(rows, schema)

    return run, "shard long, target long, hashes binary, hot binary"


_FRAGMENTS = pa.schema(
    [("target", pa.int64()), ("shard", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("starts", pa.binary()), ("hashes", pa.binary()), ("sizes", pa.binary()), ("texts", pa.large_binary()), ("removed", pa.bool_())]
)
_FRAGMENTS_SQL = "target long, shard long, ids binary, rows binary, starts binary, hashes binary, sizes binary, texts binary, removed boolean"
_FIRST = np.iinfo(np.int64).min


def _cut(counters: int, targets: int):
    schema = _FRAGMENTS.set(7, pa.field("texts", pa.binary()))

    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return _table([], schema)
        shard = docs.column("shard")[0].as_py()
        ids, texts, _ = _rows(docs)
        known, hot = [], []
        for target, hashes, flags in zip(*(shared.column(c).to_pylist() for c in ("target", "hashes", "hot"))):
            known.append(np.uint64(target) << np.uint64(32) | np.frombuffer(hashes, np.uint32).astype(np.uint64))
            hot.append(np.frombuffer(flags, np.uint8))
        known, hot = np.concatenate(known), np.concatenate(hot)
        order = np.argsort(known)
        known, hot = known[order], hot[order]
        found = anchors(texts)
        key = _target(found["hash"], counters).astype(np.uint64) << np.uint64(32) | (found["hash"] & _LOW)
        place = np.minimum(np.searchsorted(known, key), len(known) - 1)
        mine = np.flatnonzero(known[place] == key)
        fragments: list[tuple[int, int, int, int, bytes]] = []  # target, row, start, hash, text
        to = _target(found["hash"], targets)
        for row, start, count, target, k, is_hot in zip(*(x[mine].tolist() for x in (found["text"], found["start"], found["count"], to, key)), hot[place[mine]].tolist()):
            text = texts[row]
            if not is_hot:
                fragments.append((target, row, start, k & 0xFFFFFFFF, text[start : start + count + LENGTH - 1]))
                continue
            for s in range(start, start + count):
                window = text[s : s + LENGTH]
                own = xxhash.xxh64_intdigest(window, 11)
                fragments.append(((own >> 32) * targets >> 32, row, s, own & 0xFFFFFFFF, window))
        # rows are in order of the ids, runs in order of starts: the first of equal fragments is the earliest
        first: dict[bytes, int] = {}
        keep, gone = [], []
        for i, fragment in enumerate(fragments):
            (keep if first.setdefault(fragment[4], i) == i else gone).append(fragment)
        number = [_FIRST if i is None else i for i in ids]
        rows = []
        for target, m in _groups(np.array([f[0] for f in keep], np.int64)):
            part = [keep[i] for i in m.tolist()]
            rows.append((
                target, shard, np.array([number[f[1]] for f in part], np.int64).tobytes(), np.array([f[1] for f in part], np.int32).tobytes(),
                np.array([f[2] for f in part], np.int64).tobytes(), np.array([f[3] for f in part], np.uint32).tobytes(),
                np.array([len(f[4]) for f in part], np.int32).tobytes(), b"".join(f[4] for f in part), False,
            ))
        if gone:
            rows.append((
                shard % targets, shard, None, np.array([f[1] for f in gone], np.int32).tobytes(), np.array([f[2] for f in gone], np.int64).tobytes(),
                None, np.array([len(f[4]) for f in gone], np.int32).tobytes(), None, True,
            ))
        return _table(rows, schema)

    return run, _FRAGMENTS_SQL


def repeated_windows(fragments: list[bytes], anchor: np.ndarray, block: int = _BLOCK) -> Iterator[tuple[int, int, int]]:
    """(fragment, offset, number) of runs of windows that an earlier fragment of its anchor has too.

    Fragments come in order of anchor, then of place in the corpus. Blocks are bounded; an anchor that runs
    over blocks is looked up in those before it by binary search.
    """
    sizes = np.cumsum([len(f) for f in fragments])
    begin, open_blocks = 0, []
    while begin < len(fragments):
        end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + block, side="right")))
        now = Block(fragments[begin:end])
        open_blocks = [(b, a) for b, a in open_blocks if a == anchor[begin]]
        if open_blocks:
            at = now.windows(anchor[begin:end] == anchor[begin])
            for earlier, _ in open_blocks:
                at = at[~now.repeated[at]]
                now.repeated[at[earlier.holds(now, at)]] = True
        at = np.flatnonzero(now.repeated)
        if len(at):
            cut = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(now.fragment[at]) != 0)])
            for first, number in zip(at[cut].tolist(), np.diff(np.r_[cut, len(at)]).tolist()):
                fragment = int(now.fragment[first])
                yield begin + fragment, first - int(now.starts[fragment]), number
        if end < len(fragments) and anchor[end - 1] == anchor[end]:
            open_blocks.append((now, anchor[end]))
        begin = end


def _resolve():
    schema = pa.schema([("shard", pa.int64()), ("rows", pa.binary()), ("starts", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []  # shard, row, start, windows
        rows = []
        seen: dict[bytes, tuple] = {}  # fragment: hash, id, shard, row, start of the earliest
        for r in table.to_batches(64):
            for shard, ids, numbers, starts, hashes, sizes, text, removed in zip(*(r.column(c).to_pylist() for c in ("shard", "ids", "rows", "starts", "hashes", "sizes", "texts", "removed"))):
                if removed:
                    counts = np.frombuffer(sizes, np.int32) - (LENGTH - 1)
                    rows.append((shard, numbers, starts, counts.astype(np.int32).tobytes()))
                    continue
                at = 0
                for i, row, start, h, size in zip(*(np.frombuffer(x, k).tolist() for x, k in ((ids, np.int64), (numbers, np.int32), (starts, np.int64), (hashes, np.uint32), (sizes, np.int32)))):
                    fragment, mine = text[at : at + size], (h, i, shard, row, start)
                    at += size
                    best = seen.setdefault(fragment, mine)
                    if best is not mine:
                        if mine < best:
                            seen[fragment], mine = mine, best
                        out.append((mine[2], mine[3], mine[4], size - LENGTH + 1))
        order = sorted(seen.items(), key=lambda x: x[1])
        anchor = np.array([x[1][0] for x in order], np.int64)
        # a fragment alone at its anchor has no window to share
        if len(anchor):
            company = np.r_[False, anchor[1:] == anchor[:-1]]
            company |= np.r_[company[1:], False]
            order = [order[i] for i in np.flatnonzero(company).tolist()]
            for i, offset, number in repeated_windows([x[0] for x in order], anchor[company]):
                _, _, shard, row, start = order[i][1]
                out.append((shard, row, start + offset, number))
        if out:
            flat = np.array(out, np.int64)
            for shard, m in _groups(flat[:, 0]):
                rows.append((shard, flat[m, 1].astype(np.int32).tobytes(), flat[m, 2].tobytes(), flat[m, 3].astype(np.int32).tobytes()))
        return _table(rows, schema)

    return run, "shard long, rows binary, starts binary, counts binary"


def merged_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of intervals."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    cut = np.flatnonzero(np.r_[True, starts[1:] > stops[:-1]])
    return starts[cut], stops[np.r_[cut[1:] - 1, len(starts) - 1]]


def _finish(schema: pa.Schema, sql: str, columns: list[str]):
    """Rows of the shard's documents with what is left of them; ``columns`` are passed on, the text cut."""

    def run(docs: pa.Table, removed: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        ids, texts, _ = _rows(docs)
        spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if removed.num_rows:
            row = np.concatenate([np.frombuffer(x, np.int32) for x in removed.column("rows").to_pylist()])
            start = np.concatenate([np.frombuffer(x, np.int64) for x in removed.column("starts").to_pylist()])
            stop = start + np.concatenate([np.frombuffer(x, np.int32) for x in removed.column("counts").to_pylist()]) + LENGTH - 1
            spans = {r: merged_spans(start[m], stop[m]) for r, m in _groups(row)}
        left: dict[tuple, tuple] = {}
        for r, (i, text) in enumerate(zip(ids, texts)):
            begins, ends = spans.get(r, ((), ()))
            parts, at = [], 0
            for b, e in zip(begins, ends):
                parts.append(text[at:b])
                at = e
            parts.append(text[at:])
            left[i, text] = (b"".join(parts), len(begins))
        kept = [left[row] for row in zip(docs.column("doc_id").to_pylist(), [x or b"" for x in docs.column("text").cast(pa.binary()).to_pylist()])]
        if columns:
            # a character that lost some of its bytes goes as a whole; a null text stays null
            nulls = docs.column("text").is_null().to_pylist()
            cut = pa.array([None if n else k[0].decode("utf-8", "ignore") for k, n in zip(kept, nulls)], pa.string())
            return pa.table([cut if c == "text" else docs.column(c) for c in columns], names=columns)
        sizes = [len(x or b"") for x in docs.column("text").cast(pa.binary()).to_pylist()]
        return pa.table(
            [
                docs.column("doc_id"), pa.array(sizes, pa.int64()), pa.array([n - len(k[0]) for n, k in zip(sizes, kept)], pa.int64()),
                pa.array([k[1] for k in kept], pa.int64()), pa.array([hashlib.sha256(k[0]).hexdigest() for k in kept], pa.string()),
            ],
            schema=schema,
        )

    return run, sql


def _passes(rows: DataFrame, hot: int, finish) -> DataFrame:
    """The five passes over rows with doc_id and text; the shuffled documents are read three times."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(shuffle_partitions(rows.sparkSession), -(-int(total) // SHARD_BYTES))
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("long"))
    counters = max(shuffle_partitions(rows.sparkSession), -(-int(total) // TARGET_BYTES))
    survey = sharded.groupBy("shard").applyInArrow(*_survey(counters))
    shared = survey.groupBy("target").applyInArrow(*_shared(hot))
    cut = sharded.groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(*_cut(counters, shards))
    removed = cut.groupBy("target").applyInArrow(*_resolve())
    return sharded.groupBy("shard").cogroup(removed.groupBy("shard")).applyInArrow(*finish)


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row for each document: bytes, bytes removed, spans and the hash of what is left."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    schema = pa.schema([(x.split()[0], k) for x, k in zip(_DIGEST.split(", "), kinds)])
    return _passes(rows, hot, _finish(schema, _DIGEST, []))


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The documents, all their columns, with repeated bytes cut from ``text``; ids are in ``doc_id``.

    Characters that lose some of their bytes go as a whole. A document of which nothing is left stays,
    with an empty text.
    """
    columns = docs.columns
    renamed = {c: fresh(c, columns) for c in columns if c.lower() == "shard"}
    rows = docs.withColumnsRenamed(renamed)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    names = rows.columns
    sql = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    out = _passes(rows, hot, _finish(to_arrow_schema(rows.schema), sql, names))
    return out.select(*(F.col(renamed.get(c, c)).alias(c) for c in columns))
