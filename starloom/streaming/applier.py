"""Structured Streaming over the same operators as the batch path.

Order changes arrive as JSON envelopes.  Each micro-batch is appended to the equality-delete table;
as positions decide and not arrival, a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.functions.text import hex_position
from starloom.operators.changefeed import HEADER, LINE, EqualityDeleteTable
from starloom.sources.connectors import decode

MESSAGE = "key string, value string"
TYPES = {"order_id": "int", "product_id": "int", "unit_price": "decimal(19,4)", "quantity": "smallint", "discount": "float", "freight": "decimal(19,4)", "ship_name": "string", "order_date": "timestamp_ntz"}


def changes_of(envelopes: DataFrame) -> DataFrame:
    """Decoded envelopes as the change rows EqualityDeleteTable.append takes."""
    pos = F.struct(hex_position(F.col("lsn")).alias("start_lsn"), F.coalesce(hex_position(F.col("seqval")), F.lit("0" * 20)).alias("seqval"))
    cols = {c: F.try_element_at("data", F.lit(c)).try_cast(t).alias(c) for c, t in TYPES.items()}
    return envelopes.select("capture_instance", pos.alias("pos"), F.col("operation").try_cast("int").alias("operation"), *(cols[c] for c in ["order_id", "product_id", *LINE, *HEADER]))


def apply_orders(spark: SparkSession, messages: DataFrame, table: EqualityDeleteTable, checkpoint: str, dead_letters: str, trigger: dict | None = None) -> StreamingQuery:
    """Append every message's change; what can't be read goes to the dead-letter folder with its batch."""

    def batch(df: DataFrame, batch_id: int) -> None:
        d = decode(df)
        bad = F.col("capture_instance").isNull() | F.col("lsn").isNull()
        d.filter(bad).select("raw", F.lit(batch_id).alias("batch_id")).write.mode("append").json(dead_letters)
        table.append(changes_of(d.filter(~bad)).filter(F.col("operation").isin(1, 2, 4)))

    return messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_files(spark: SparkSession, path: str, schema: str = MESSAGE, per_batch: int = 1, form: str = "json") -> DataFrame:
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", per_batch).load(path)


def tumbling(events: DataFrame, at: str, width: str, lateness: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums per window and keys; late events correct a window until the watermark passes it."""
    return _windowed(events, at, lateness, F.window("__sl_at", width), keys, value)


def sliding(events: DataFrame, at: str, width: str, step: str, lateness: str, keys: list[str], value: str) -> DataFrame:
    return _windowed(events, at, lateness, F.window("__sl_at", width, step), keys, value)


def sessions(events: DataFrame, at: str, gap: str, lateness: str, keys: list[str], value: str) -> DataFrame:
    return _windowed(events, at, lateness, F.session_window("__sl_at", gap), keys, value)


def _windowed(events: DataFrame, at: str, lateness: str, window, keys: list[str], value: str) -> DataFrame:
    e = events.withColumn("__sl_at", F.col(at).cast("timestamp")).withWatermark("__sl_at", lateness)
    d = e.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total"))
    return d.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "events", F.round("total", 4).alias("total"))


def run_to_end(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there now and stop."""
    q = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
