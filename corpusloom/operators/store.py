"""Keyed merges and patches of tables, as DataFrames and on Parquet tables.

The pure forms return the new table. :class:`Store` keeps each table as a folder of Parquet versions. A version
counts once its pointer, a small file named by the version's number, has been renamed into place; the greatest
number is the current one. So a table is never overwritten while it is read, a writer that dies leaves the last
version as it was, and of two writers of one number the second fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def one_each(rows: DataFrame, key: str = "id") -> DataFrame:
    """One row for each key, the same one in every run, so that a key changed twice doesn't multiply its row."""
    values = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    turn = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*values)))
    return rows.withColumn("_turn_", turn).where("_turn_ = 1").drop("_turn_")


def upsert(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those with the same key; null keys are refused.

    Of several new rows of a key one is taken, whatever their order.
    """
    new = one_each(new, key)
    if not new.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key}")
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns).unionByName(new, allowMissingColumns=True)


def patch(existing: DataFrame, changes: DataFrame, columns: list[str], key: str = "id", only_filled: bool = False) -> DataFrame:
    """Columns of rows with a change take its value; with ``only_filled`` null and empty values change nothing."""
    marked = one_each(changes.select(key, *columns), key).select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = existing.join(marked, key, "left")
    hit = F.coalesce("_hit", F.lit(False))

    def value(c: str) -> Column:
        new = F.col(f"_new_{c}")
        if only_filled:
            new = F.when(new.cast("string") != "", new)
            return F.coalesce(F.when(hit, new), F.col(c))
        return F.when(hit, new).otherwise(F.col(c))

    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in existing.columns])


def verify(pairs: DataFrame, decisions: DataFrame, now: Column) -> DataFrame:
    """Q&A pairs after decisions (id, reviewer_id, review_notes): verified, notes replaced also by null."""
    d = one_each(decisions.select("id", "reviewer_id", "review_notes")).select("id", F.lit(True).alias("_hit"), F.col("reviewer_id").alias("_by"), F.col("review_notes").alias("_notes"))
    hit = F.coalesce("_hit", F.lit(False))
    out = pairs.join(d, "id", "left").withColumns({
        "verified": hit | F.col("verified"), "reviewer_id": F.when(hit, F.col("_by")).otherwise(F.col("reviewer_id")),
        "review_notes": F.when(hit, F.col("_notes")).otherwise(F.col("review_notes")), "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
    })
    return out.select(*pairs.columns)


def orphans(child: DataFrame, parent: DataFrame, foreign: str, key: str = "id") -> DataFrame:
    """Rows of a child table whose reference isn't there."""
    return child.where(F.col(foreign).isNotNull()).join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")


class Store:
    """Tables under a folder of any file system that Spark writes to: append, replace, read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _numbers(self, table: str) -> list[int]:
        folder = self._path(f"{self.folder}/{table}")
        if not self._files.exists(folder):
            return []
        names = [x.getPath().getName() for x in self._files.listStatus(folder)]
        return sorted(int(n[8:-5]) for n in names if n.startswith("version-") and n.endswith(".json"))

    def _pointer(self, table: str, number: int) -> str:
        return f"{self.folder}/{table}/version-{number:08d}.json"

    def _current(self, table: str) -> dict:
        stream = self._files.open(self._path(self._pointer(table, self._numbers(table)[-1])))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(*self._current(table)["parts"])

    def exists(self, table: str) -> bool:
        return bool(self._numbers(table))

    def _write(self, table: str, df: DataFrame, kept: list[str]) -> None:
        number = next(reversed(self._numbers(table)), -1) + 1
        mark = uuid.uuid4().hex
        part, draft = f"{self.folder}/{table}/v{number:08d}-{mark}", self._path(f"{self.folder}/{table}/_draft-{mark}")
        df.write.parquet(part)
        stream = self._files.create(draft, False)
        try:
            stream.write(json.dumps({"number": number, "parts": [*kept, part]}).encode())
        finally:
            stream.close()
        target = self._path(self._pointer(table, number))
        if self._files.exists(target) or not self._files.rename(draft, target):
            self._files.delete(draft, False)
            raise RuntimeError(f"another writer has made version {number} of {table}")

    def append(self, table: str, df: DataFrame) -> None:
        self._write(table, df, self._current(table)["parts"] if self.exists(table) else [])

    def replace(self, table: str, df: DataFrame) -> None:
        self._write(table, df, [])

    def upsert(self, table: str, df: DataFrame, key: str = "id") -> None:
        self.replace(table, upsert(self.read(table), df, key) if self.exists(table) else df)
