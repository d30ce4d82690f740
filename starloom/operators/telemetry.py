"""Stream telemetry: health, lag, outcomes, feeds and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_ms(applied: Column, source: Column) -> Column:
    return F.unix_millis(applied.cast("timestamp")) - F.unix_millis(source.cast("timestamp"))


def failed(error: Column) -> Column:
    return F.coalesce(F.length(F.rtrim(error)) > 0, F.lit(False))


def health(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Per capture instance: events, rows written, mean, 95th percentile and longest lag, last event, errors, and those of the hour before ``now`` (the last event of all)."""
    last = events.agg(F.max("event_time")).first()[0] if now is None else None
    anchor = now if now is not None else F.lit(last)
    err = failed(F.col("error"))
    return events.groupBy("capture_instance").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("rows_written").cast("bigint").alias("rows_written"),
        F.round(F.avg("lag_ms"), 3).alias("avg_lag_ms"),
        F.round(F.percentile("lag_ms", F.lit(0.95)), 3).alias("p95_lag_ms"),
        F.max("lag_ms").alias("max_lag_ms"),
        F.max("event_time").alias("last_event"),
        F.count_if(err).alias("errors"),
        F.count_if(F.col("event_time") > anchor - F.expr("INTERVAL 1 HOUR")).alias("events_last_hour"),
    )


def per_minute(events: DataFrame, at: str = "event_time") -> DataFrame:
    """Tumbling minutes with events, mean and 95th percentile of lag."""
    return events.groupBy(F.date_trunc("minute", at).alias("minute")).agg(F.count(F.lit(1)).alias("events"), F.round(F.avg("lag_ms"), 3).alias("avg_lag_ms"), F.round(F.percentile("lag_ms", F.lit(0.95)), 3).alias("p95_lag_ms"))


def top_with_other(df: DataFrame, term: str, n: int, other: str = "Other") -> DataFrame:
    """Counts of the n most frequent values and of all others together; ties go by value."""
    counts = df.groupBy(F.col(term).alias("term")).agg(F.count(F.lit(1)).alias("events"))
    top = counts.orderBy(F.desc("events"), "term").limit(n).select(F.col("term").alias("__sl_top"))
    named = counts.join(F.broadcast(top), F.col("term") == F.col("__sl_top"), "left")  # n rows
    return named.groupBy(F.coalesce("__sl_top", F.lit(other)).alias("term")).agg(F.sum("events").cast("bigint").alias("events"))


def counter_rate(df: DataFrame, series: str, at: Column, value: str) -> DataFrame:
    """A cumulative counter's increase per time bucket: maximum less the one before, restarting at a fall."""
    per = df.groupBy(series, at.alias("bucket")).agg(F.max(value).alias("peak"))
    before = F.lag("peak").over(Window.partitionBy(series).orderBy("bucket"))
    return per.withColumn("increase", F.when(before.isNull(), F.lit(None)).when(F.col("peak") < before, F.col("peak")).otherwise(F.col("peak") - before))


def keep_newer(df: DataFrame, at: str, days: int, now: Column) -> DataFrame:
    """Rows within their time to live."""
    return df.filter(F.col(at) >= now - F.make_interval(days=F.lit(days)))
