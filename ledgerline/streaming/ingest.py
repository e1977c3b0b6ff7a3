"""Filings as a stream: files land, are registered once by content, reconciled and stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import registry


def file_stream(spark: SparkSession, path: str, glob: str = "*.csv", files_per_trigger: int = 1000) -> DataFrame:
    """New files under ``path`` as (path, content, modificationTime, length)."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).load(path)


def ingest(stream: DataFrame, describe: Callable[[DataFrame], DataFrame], manifest_path: str, store_dir: str, checkpoint: str, handle: Callable[[DataFrame, int], None], fetched_at: str) -> StreamingQuery:
    """Register each batch, keep its new documents' bytes and hand them to ``handle``.

    ``describe`` adds (bank_id, period, template, url, source_kind) to
    (path, content). A batch that is replayed after a failure finds its
    content in the ledger, so each document is handled once: the ledger is
    written after ``handle`` succeeds, and ``handle`` must be idempotent per
    batch id.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        incoming = describe(df.select("path", "content"))
        rows = registry.register(registry.scan(spark, manifest_path), incoming.drop("path"), store_dir, fetched_at).persist()
        try:
            fresh = registry.fresh(incoming, rows)
            registry.store_content(fresh)
            handle(fresh, batch_id)
            registry.append(rows, manifest_path)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_activity(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Restatement and filing activity: counts per window and type under a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
