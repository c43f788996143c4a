"""Incremental jobs: annotation of new documents, deduplication by hash, queue transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.hashing import content_hash
from corpusloom.operators import annotate, queueing
from corpusloom.operators.store import Store


def annotate_stream(spark: SparkSession, folder: str, schema, store: Store, checkpoint: str, id: str = "doc_id") -> StreamingQuery:
    """New Parquet files under the folder are annotated; each batch appends documents and Q&A pairs once."""
    source = spark.readStream.schema(schema).parquet(folder)

    def sink(batch: DataFrame, epoch: int) -> None:
        annotated = annotate.annotate(batch).persist()
        rows = annotate.table_columns(annotated, id)
        # a batch that is run again replaces its own rows
        store.upsert("raw_ingest", rows)
        store.upsert("qa_pairs", annotate.qa_rows(annotated, id))
        annotated.unpersist()

    return source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_content(stream: DataFrame, text: str = "text", time: str = "ts", horizon: str = "1 hour") -> DataFrame:
    """The first row of each content within the watermark's horizon."""
    hashed = stream.withColumn("content_hash", content_hash(F.col(text)))
    return hashed.withWatermark(time, horizon).dropDuplicatesWithinWatermark(["content_hash"])


def outcome_sink(store: Store, table: str = "crawl_queue"):
    """A foreachBatch function that applies outcomes (id, success, error, context_id) to the stored queue."""

    def sink(batch: DataFrame, epoch: int) -> None:
        latest = batch.dropDuplicates(["id"])
        store.replace(table, queueing.transition(store.read(table), latest, F.current_timestamp()))

    return sink
