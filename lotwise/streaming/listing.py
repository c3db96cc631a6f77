"""Landed pages as a stream: summary rows, and detail envelopes into the outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.detail import detail_rows
from ..sinks.outbox import outbox_writer


def landed_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New pages of the landing table as they come."""
    columns = "spider string, url string, html string, http_status int, fetched_at timestamp, s3_key string, parser_version string, source string, dt date"
    return spark.readStream.schema(columns).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def publish_details(pages: DataFrame, source: str, outbox: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Parse detail pages as they land and write their envelopes to the outbox.

    The query's progress has the batch's counts under "details" (see detail_rows).
    """
    items = detail_rows(pages, source, observed="details").withColumn("item_type", F.lit("detail"))
    writer = items.writeStream.foreachBatch(outbox_writer(outbox)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
