"""Byte-level BPE by a deterministic tokenization automaton.

The merges are compiled, in order, into an automaton over token labels that accepts exactly the token
sequences BPE produces. It starts as one state that takes every byte. The gadget of merge k, (a, b) -> c,
gives the state after ``a`` a successor that no longer takes ``b`` (and none of what starts with ``b``
from then on), and adds an arc ``c`` to where ``b`` led before, wherever ``a`` is taken. States share
their arcs: a state is its predecessor less one label, so it is stored as a list of bans with the merge
numbers at which they came into force, and whether a state takes a label is read from the bans on the
label's left spine and the state's right spine (:meth:`Automaton.takes`), once, and then kept in a
transition table.

Encoding a pre-split word follows byte transitions of the vocabulary's trie and label transitions of the
automaton; each prefix of a word has exactly one accepted label sequence, so one label is kept for each
position. Decoding emits the labels of the arcs. The results equal those of the public ``tokenizers``
library on the same file, added tokens included.

Defined results: null and empty texts have no tokens; texts of any length are encoded whole; repeated
rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, utf8

#: The byte-level pre-tokenizer's pattern, with white space as that library's regular expressions have it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words and runs that a worker keeps, some 200 bytes each.
_CACHE = 3 << 19


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The compiled merges; picklable, read-only but for its tables of transitions found so far."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]], added: dict[str, int]):
        self.labels, self.added = labels, added
        size = len(labels)
        self.left, self.right = [-1] * size, [-1] * size
        never = len(merges)
        self.birth = [-1] * size
        self.bans: dict[int, int] = {}
        for k, (a, b, c) in enumerate(merges):  # one gadget after another
            self.bans.setdefault(a << 20 | b, k)
            if self.birth[c] < 0 and len(labels[c]) > 1:
                self.left[c], self.right[c], self.birth[c] = a, b, k
        self.never = never
        special = set(added.values())
        made = [t for t in range(size) if t not in special and (len(labels[t]) == 1 or self.birth[t] >= 0)]
        # the trie of all labels that an arc can have
        self.step: dict[int, int] = {}
        self.token: list[int] = [-1]
        for t in made:
            node = 0
            for byte in labels[t]:
                key = node << 8 | byte
                if (following := self.step.get(key)) is None:
                    following = self.step[key] = len(self.token)
                    self.token.append(-1)
                node = following
            self.token[node] = t
        self._reset()

    def _reset(self) -> None:
        self.table: dict[int, bool] = {}
        self.words, self.spaced = _Words(self), _Spaced(self)
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True))).split if self.added else None
        self.mark = regex.compile("|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True))).findall if self.added else None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "words", "spaced", "split", "cut", "mark")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._reset()

    @classmethod
    def load(cls, path: str | None = None) -> Automaton:
        data = json.loads(Path(path or default_path()).read_text("utf-8"))
        vocabulary, letters = data["model"]["vocab"], byte_letters()
        added = {x["content"]: x["id"] for x in data["added_tokens"]}
        labels = [b""] * (1 + max([*vocabulary.values(), *added.values()]))
        for word, i in vocabulary.items():
            labels[i] = bytes(letters[x] for x in word)
        for word, i in added.items():
            labels[i] = word.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
        return cls(labels, [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], added)

    def takes(self, state: int, label: int) -> bool:
        """Whether the state after label ``state`` has an arc ``label``."""
        bans, left, right, birth = self.bans, self.left, self.right, self.birth
        u, seen_before = state, self.never
        while u >= 0:
            v, came_by = label, self.never
            while v >= 0:
                k = bans.get(u << 20 | v)
                if k is not None and k < seen_before and k <= came_by:
                    return False
                came_by, v = birth[v], left[v]
            seen_before, u = birth[u], right[u]
        return True

    def encode_word(self, word: bytes) -> list[int]:
        n, step, token, table = len(word), self.step, self.token, self.table
        last, origin = [-1] * (n + 1), [0] * (n + 1)
        for j in range(n):
            state = last[j]
            if j and state < 0:
                continue
            node = 0
            for i in range(j, n):
                node = step.get(node << 8 | word[i])
                if node is None:
                    break
                t = token[node]
                if t < 0 or last[i + 1] >= 0:
                    continue
                if j:
                    key = state << 20 | t
                    taken = table.get(key)
                    if taken is None:
                        taken = table[key] = self.takes(state, t)
                    if not taken:
                        continue
                last[i + 1], origin[i + 1] = t, j
        out, i = [], n
        while i:
            out.append(last[i])
            i = origin[i]
        out.reverse()
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.cut is None:
            return self._encode_plain(text)
        parts = self.cut(text)
        if len(parts) == 1:
            return self._encode_plain(text)
        out = []
        for part, mark in zip(parts, [*self.mark(text), None]):
            out.append(self._encode_plain(part))
            if mark is not None:
                out.append(self.added[mark].to_bytes(4, "little"))
        return b"".join(out)

    def _encode_plain(self, text: str) -> bytes:
        words, spaced = self.words, self.spaced
        if len(words) + len(spaced) > _CACHE:
            words.clear()
            spaced.clear()
            self.table.clear()
        # Where single spaces divide runs that neither begin nor end in white space, the pattern cuts
        # before each of these spaces, whatever else it does, so the runs can be looked up as they are.
        first, *rest = text.split(" ")
        try:
            if first and not first[-1].isspace():
                return b"".join([*map(words.__getitem__, self.split(first)), *map(spaced.__getitem__, rest)])
        except _Uneven:
            pass
        return b"".join(map(words.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        """The labels of the arcs, joined; bytes that aren't UTF-8 become replacement characters."""
        joined = b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined.decode("utf-8", "replace").encode()


class _Uneven(Exception):
    """A run that borders on more white space than one space."""


class _Words(dict):
    """Packed ids of the pre-split words met so far."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        found = self[word] = np.array(self.automaton.encode_word(word.encode()), "<u4").tobytes()
        return found


class _Spaced(dict):
    """Packed ids of the runs met so far, each with the space before it."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, run: str) -> bytes:
        if not run or run[0].isspace() or run[-1].isspace():
            raise _Uneven
        first, *rest = self.automaton.split(" " + run)
        found = np.array(self.automaton.encode_word(first.encode()), "<u4").tobytes()
        if rest:
            found += b"".join(map(self.automaton.words.__getitem__, rest))
        if len(run) < 64:
            self[run] = found
        return found


def broadcast_automaton(spark, path: str | None = None) -> Broadcast:
    """The automaton for all executors; the vocabulary file bounds its size (a few MB)."""
    return spark.sparkContext.broadcast(Automaton.load(path))


def _ids_array(ids: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id and the token ids of every whole text."""
    shared = broadcast_automaton(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for part in bounded(batch):
                ids = [automaton.encode(x.decode("utf-8", "replace")) for x in utf8(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), _ids_array(ids)], ["doc_id", "ids"])

    return docs.select(id, text).mapInArrow(run, f"doc_id {docs.schema[id].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""
    shared = broadcast_automaton(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for part in bounded(batch):
                texts = [automaton.decode(np.array(x or [], "<u4").tobytes()).decode() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Digests of each text's ids and of what they decode to, in one pass; the ids too where asked for."""
    shared = broadcast_automaton(docs.sparkSession, path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for part in bounded(batch):
                ids = [automaton.encode(x.decode("utf-8", "replace")) for x in utf8(part.column(1))]
                columns = [
                    part.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(automaton.decode(x)).hexdigest() for x in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [_ids_array(ids)] * with_ids, names)

    kind = docs.schema[id].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id), F.col(text)).mapInArrow(run, out)
