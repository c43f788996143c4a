"""Stored objects: bytes by path, text by a pluggable OCR backend, gazetteers and page tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.lexicons import GAZETTEER, Name


def read_objects(spark: SparkSession, folder: str) -> DataFrame:
    """path (below the folder) and content of all stored objects."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return rows.select(F.regexp_replace("path", r"^.*?\Q" + folder.rstrip("/") + r"\E/", "").alias("path"), "content")


def ocr(entries: DataFrame, objects: DataFrame, backend: Callable[[str, bytes], str], name: str = "default") -> DataFrame:
    """Text of each queue entry (id, context_id, asset_type, storage_path) by the backend; what fails is null with its error."""
    joined = entries.join(objects, entries["storage_path"] == objects["path"], "left")

    @F.pandas_udf("text string, error string")
    def read(kind: pd.Series, content: pd.Series) -> pd.DataFrame:
        rows = []
        for k, c in zip(kind, content):
            try:
                if c is None:
                    raise FileNotFoundError("no such object")
                rows.append((backend(k, c).strip(), None))
            except Exception as e:  # noqa: BLE001 - a bad object fails its row, not the job
                rows.append((None, str(e)))
        return pd.DataFrame(rows, columns=["text", "error"])

    out = joined.withColumn("r", read("asset_type", "content"))
    return out.select("id", "context_id", "asset_type", "storage_path", F.col("r.text").alias("text"), F.length("r.text").alias("text_length"), F.lit(name).alias("backend"), F.col("r.error").alias("error"))


def gazetteer_table(spark: SparkSession, names: tuple[Name, ...] = GAZETTEER) -> DataFrame:
    """category, ordinal, alias (lower case), canonical, is_canonical, place, kind."""
    rows = []
    for i, n in enumerate(names):
        rows.append((n.category, i, n.canonical.lower(), n.canonical, True, n.place, n.kind))
        rows += [(n.category, i, a.lower(), n.canonical, False, n.place, n.kind) for a in n.aliases]
    return spark.createDataFrame(rows, "category string, ordinal int, alias string, canonical string, is_canonical boolean, place string, kind string")
