"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, or that the session has set.

    Only on one machine (a local master, as in tests) a temporary folder is taken where none is named: executors
    elsewhere couldn't read it, so on a cluster that is an error.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if named := spark.conf.get("spark.checkpoint.dir", "") or (known.get() if known.isDefined() else ""):
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    return os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_arrow(
    df: DataFrame, columns: list[str], function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """One output batch for each input batch of the named columns; nothing is kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded(batch):
                yield function(part)

    return df.select(*columns).mapInArrow(run, schema)


def bounded(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``limit`` bytes, so that derived arrays stay small."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, min(rows, int(rows * limit / max(1, batch.nbytes))))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def fresh(base: str, columns: list[str]) -> str:
    """A column name that isn't among the given ones, whatever their case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pack(values: np.ndarray) -> bytes:
    """An array compressed by byte planes, so that high bytes that hardly differ cost little."""
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes(), 1)


def unpack(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).ravel()


def fold(doc_id: str | F.Column, modulus: int) -> F.Column:
    """crc32 of the id's decimal text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def fold_of(doc_id: int | None, modulus: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus
