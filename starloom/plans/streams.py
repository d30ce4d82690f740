"""Streaming queries run to the end of their input, next to SQL over the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.changefeed import HEADER, LINE, EqualityDeleteTable, counting_changes
from starloom.operators.standing import standing
from starloom.sources.connectors import ENVELOPE, encode
from starloom.sources.connectors import SOURCES
from starloom.sources.tables import Scratch, load
from starloom.streaming import applier

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _windows(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame], keys: list[str], mode: str = "update") -> DataFrame:
    """A windowed aggregate of events as a stream, and what its micro-batches wrote.

    In update mode a batch appends the windows it changed, and the last row of each stands; the state
    holds only windows that the watermark hasn't passed.  In append mode (sessions) a window is written
    once, when it is closed; an event of far later at the end closes them all.
    """
    batch = load(spark, sf_dir, "events")
    scratch = Scratch(spark)
    events = spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/events.parquet*")
    if mode == "append":
        end = scratch.path()
        last = F.lit("2200-01-01").cast(batch.schema["ts"].dataType)
        spark.range(1).select(*(last.alias(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema)).write.parquet(end)
        events = events.unionByName(spark.readStream.schema(batch.schema).parquet(end))
    out = scratch.path()
    d = make(events)
    applier.run_to_end(d, lambda b, n: b.withColumn("batch", F.lit(n)).write.mode("append").parquet(out), scratch.path(), mode)
    rows = spark.read.schema(T.StructType([*d.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(out)
    rows = standing(rows, keys, [c for c in d.columns if c not in keys], "batch").select(*d.columns)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, lambda e: applier.tumbling(e, "ts", "1 hour", "1 day", ["event_type"], "value"), ["window_start", "event_type"])


def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, lambda e: applier.sliding(e, "ts", "2 hours", "1 hour", "1 day", ["event_type"], "value"), ["window_start", "event_type"])


def session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, lambda e: applier.sessions(e, "ts", "6 hours", "1 day", ["user_id"], "value"), ["window_start", "user_id"], "append")


_SUMS = "count(*) AS events, round(sum(value), 4) AS total"
SQL["tumbling_window"] = f"SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, event_type, {_SUMS} FROM events GROUP BY ALL"
SQL["sliding_window"] = f"WITH w AS (SELECT date_trunc('hour', ts)::TIMESTAMP - k * INTERVAL 1 HOUR AS s, event_type, value FROM events, (SELECT unnest([0, 1]) AS k)) SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, event_type, {_SUMS} FROM w GROUP BY ALL"
SQL["session_window"] = f"""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS cut FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, user_id, {_SUMS} FROM n GROUP BY user_id, no"""


def stream_apply(spark: SparkSession, sf_dir: str) -> tuple[EqualityDeleteTable, DataFrame]:
    """Order changes as JSON messages, applied by a stream in several micro-batches."""
    scratch = Scratch(spark)
    c = counting_changes(load(spark, sf_dir, "order_changes"), load(spark, sf_dir, "stream_state"))
    c = c.select("*", F.col("pos.start_lsn").alias("lsn"), F.col("pos.seqval").alias("seqval"), F.lit(None).cast("timestamp_ntz").alias("at"))
    parts = [encode(c.filter(F.col("capture_instance") == s.capture_instance), s, "lsn", "seqval", "operation", "at", ["order_id", "product_id", *LINE, *HEADER]) for s in SOURCES[:2]]
    path = scratch.path()
    parts[0].unionByName(parts[1]).repartition(4, "key").write.json(path)
    table = EqualityDeleteTable(spark, scratch.path())
    applier.apply_orders(spark, applier.read_files(spark, path, per_batch=2), table, scratch.path(), scratch.path()).awaitTermination()
    return table, c


def stream_envelope_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = lambda c: F.col(c).cast("bigint").alias(c)
    t, _ = stream_apply(spark, sf_dir)
    return t.lines().select(big("order_id"), big("product_id"), F.col("pos.start_lsn").alias("start_lsn"), F.col("pos.seqval").alias("seqval"), big("is_deleted"))


def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after every change was appended once more."""
    t, c = stream_apply(spark, sf_dir)
    t.append(c)
    big = lambda n: F.col(n).cast("bigint").alias(n)
    return t.lines().select(big("order_id"), big("product_id"), F.col("pos.start_lsn").alias("start_lsn"), F.col("pos.seqval").alias("seqval"), big("is_deleted"))


def envelope_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines encoded as messages and read back."""
    f = load(spark, sf_dir, "order_changes").filter(F.col("capture_instance") == "dbo_OrderDetails")
    m = encode(f, SOURCES[1], "start_lsn", "seqval", "operation", "commit_time", ["order_id", "product_id", "quantity"])
    d = m.select(F.from_json("value", ENVELOPE).alias("e"))
    return d.groupBy(F.col("e.operation").cast("int").alias("operation")).agg(F.count(F.lit(1)).alias("messages"), F.sum(F.col("e.data")["quantity"].try_cast("bigint")).alias("quantity"), F.countDistinct("e.business_key").alias("keys"))


SQL["envelope_round_trip"] = "SELECT operation, count(*) AS messages, sum(quantity)::BIGINT AS quantity, count(DISTINCT order_id || '|' || product_id) AS keys FROM order_changes WHERE capture_instance = 'dbo_OrderDetails' GROUP BY ALL"

for _f in (tumbling_window, sliding_window, session_window, stream_envelope_apply, stream_replay_idempotent, envelope_round_trip):
    QUERIES[_f.__name__] = _f
