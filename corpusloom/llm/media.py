"""Media columns: texts as PNG images, read back with checksum tests, and low-frequency cosine hashes.

A payload is stored losslessly as an 8-bit greyscale PNG of width 64: signature, IHDR, IDAT chunks of a
zlib stream of filtered rows, IEND, each chunk with its CRC-32. Reading tests the signature, each
chunk's CRC, the zlib stream's Adler-32 and the size, and undoes all five row filters with numpy.
The feature is a perceptual hash: the image averaged to 32 x 32, its 8 x 8 lowest cosine-transform
coefficients, and a bit for each that lies above their median.

Defined results: null and empty texts give a payload of 64 zero bytes; texts of any length are stored
whole; equal texts give equal values; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, utf8

WIDTH = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHUNK = 1 << 16


class CorruptImage(ValueError):
    pass


def payload_of(text: bytes, unit: int = WIDTH) -> bytes:
    """The text with bytes 0 up to a positive multiple of the unit."""
    size = max(1, -(-len(text) // unit)) * unit
    return text.ljust(size, b"\0")


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode_png(payload: bytes, width: int = WIDTH, level: int = 6, filters: tuple[int, ...] = (0, 1, 2)) -> bytes:
    """A greyscale PNG of the payload; each row takes the filter of the least absolute differences."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    height = len(rows)
    forms = {0: rows}
    if 1 in filters:
        left = rows.copy()
        left[:, 1:] -= rows[:, :-1]
        forms[1] = left
    if 2 in filters:
        up = rows.copy()
        up[1:] -= rows[:-1]
        forms[2] = up
    kinds = [f for f in filters if f in forms]
    cost = np.stack([np.abs(forms[f].view(np.int8).astype(np.int16)).sum(axis=1) for f in kinds])
    choice = cost.argmin(axis=0)
    out = np.empty((height, width + 1), np.uint8)
    for i, f in enumerate(kinds):
        mine = choice == i
        out[mine, 0] = f
        out[mine, 1:] = forms[f][mine]
    packed = zlib.compress(out.tobytes(), level)
    parts = [_SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))]
    parts += [_chunk(b"IDAT", packed[i : i + _CHUNK]) for i in range(0, len(packed), _CHUNK)]
    parts.append(_chunk(b"IEND", b""))
    return b"".join(parts)


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo the row filters of 8-bit one-channel rows: runs of None, Sub and Up as arrays, others by row."""
    height, width = rows.shape
    out = np.empty_like(rows)
    previous = np.zeros(width, np.uint8)
    cuts = np.flatnonzero(np.diff(kinds)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), height]):
        kind, part = int(kinds[start]), rows[start:end]
        if kind == 0:
            out[start:end] = part
        elif kind == 1:
            np.cumsum(part, axis=1, dtype=np.uint8, out=out[start:end])
        elif kind == 2:
            np.cumsum(part, axis=0, dtype=np.uint8, out=out[start:end])
            out[start:end] += previous
        elif kind in (3, 4):
            above = previous.astype(int).tolist()
            for y in range(start, end):
                row, left, corner = rows[y].tolist(), 0, 0
                for x in range(width):
                    up = above[x]
                    if kind == 3:
                        guess = (left + up) >> 1
                    else:
                        p = left + up - corner
                        a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                        guess = left if a <= b and a <= c else up if b <= c else corner
                    left, corner = (row[x] + guess) & 255, up
                    row[x] = left
                out[y] = above = row
        else:
            raise CorruptImage(f"filter {kind}")
        previous = out[end - 1]
    return out


def decode_png(data: bytes) -> np.ndarray:
    """The samples as an array (height, width), after all checks."""
    if data[:8] != _SIGNATURE:
        raise CorruptImage("signature")
    at, packed, size, ended = 8, [], None, False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise CorruptImage("truncated")
        (length,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + length]
        if len(body) < length or struct.unpack_from(">I", data, at + 8 + length)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise CorruptImage(f"checksum of {kind!r}")
        if kind == b"IHDR":
            *size, depth, colour, method, filtering, interlace = struct.unpack(">IIBBBBB", body)
            if (depth, colour, method, filtering, interlace) != (8, 0, 0, 0, 0):
                raise CorruptImage("only 8-bit greyscale without interlacing is read")
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + length
    if size is None or not ended:
        raise CorruptImage("no header or end")
    width, height = size
    try:
        raw = zlib.decompress(b"".join(packed))
    except zlib.error as e:
        raise CorruptImage(str(e)) from e
    if len(raw) != height * (width + 1):
        raise CorruptImage("size")
    rows = np.frombuffer(raw, np.uint8).reshape(height, width + 1)
    return unfilter(rows[:, 0], rows[:, 1:])


_SIDE, _LOW = 32, 8
_COSINES = np.cos(np.pi * np.outer(np.arange(_LOW), 2 * np.arange(_SIDE) + 1) / (2 * _SIDE))


def _shrink(image: np.ndarray, axis: int) -> np.ndarray:
    """Means of 32 stretches along an axis; a shorter axis repeats its samples."""
    n = image.shape[axis]
    if n < _SIDE:
        return image.take(np.arange(_SIDE) * n // _SIDE, axis=axis).astype(np.float64)
    starts = np.arange(_SIDE) * n // _SIDE
    sums = np.add.reduceat(image, starts, axis=axis, dtype=np.float64)
    shape = [1, 1]
    shape[axis] = _SIDE
    return sums / np.diff(np.append(starts, n)).reshape(shape)


def cosine_hash(image: np.ndarray) -> str:
    """16 hex digits: which of the 8 x 8 lowest frequencies lie above their median."""
    small = _shrink(_shrink(image, 1), 0)
    low = np.round(_COSINES @ small @ _COSINES.T, 6).ravel()
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def store(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes and the media column (PNG bytes) of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column(1))
        media = [encode_png(payload_of(x)) for x in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"]
        )

    return map_arrow(docs, [id, text], run, f"doc_id {docs.schema[id].dataType.simpleString()}, n_bytes long, media binary")


def features(stored: DataFrame) -> DataFrame:
    """Digests and the hash of each stored image, computed from what is read back of it."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for media in batch.column(2).to_pylist():
            image = decode_png(media)
            payload = image.tobytes()
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), cosine_hash(image)))
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    kind = stored.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_arrow(stored, ["doc_id", "n_bytes", "media"], run, out)
