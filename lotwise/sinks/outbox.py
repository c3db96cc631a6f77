"""Publishing: versioned envelopes go to an outbox table that a relay can read.

There is no broker here. An outbox row has what a durable, persistent, mandatory publish
needs; its status says what came of it, and a failed row never fails a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Where detail rows are published, and the envelope's version.
EXCHANGE = "listings"
ROUTING_KEY = "listing.observed"
SCHEMA_VERSION = 1
OUTCOMES = ("sent", "unroutable", "refused")


def envelopes(items: DataFrame, run: str | None = None) -> DataFrame:
    """message_id, exchange, routing_key, body, status of each detail row; other rows are not published.

    items has item_type and the row's columns. body is the row as JSON with its nulls and
    schema_version. Messages with one body are told apart by message_id: the run (a new one
    for each call), the row's number in it, and a hash of the body.
    """
    columns = [c for c in items.columns if c != "item_type"]
    body = F.to_json(F.struct(*columns, F.lit(SCHEMA_VERSION).alias("schema_version")), {"ignoreNullFields": "false"})
    message = F.concat_ws("-", F.lit(run or uuid.uuid4().hex), F.monotonically_increasing_id().cast("string"), F.hex(F.xxhash64("body")))
    return items.filter(F.col("item_type") == "detail").select(body.alias("body")).select(
        message.alias("message_id"), F.lit(EXCHANGE).alias("exchange"), F.lit(ROUTING_KEY).alias("routing_key"), "body", F.lit("pending").alias("status")
    )


def append_outbox(envelope: DataFrame, path: str) -> None:
    envelope.write.mode("append").parquet(path)


def outbox_writer(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over items: writes their envelopes; a batch that is run again replaces what it wrote before."""

    def write(items: DataFrame, batch_id: int) -> None:
        envelopes(items, run=f"batch{batch_id}").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def with_outcome(outbox: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outbox rows with what the relay reports (message_id, outcome): sent, unroutable or refused.

    Of several reports on one message the last in that order counts.
    """
    rank = F.array_position(F.array(*map(F.lit, OUTCOMES)), F.col("outcome"))
    one = outcomes.groupBy("message_id").agg(F.max_by("outcome", rank).alias("outcome"))
    return outbox.join(one, "message_id", "left").withColumn("status", F.coalesce("outcome", "status")).drop("outcome")


def write_json_lines(rows: DataFrame, path: str) -> None:
    """One JSON object a line, UTF-8, in place of what was there."""
    rows.write.mode("overwrite").json(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Alert rows (key, us, message); delivery is up to a reader of the table."""
    alerts.write.mode("append").parquet(path)
