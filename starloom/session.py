"""A session with the settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC, adaptive execution with skew joins and coalescing, Arrow for Python operators.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str, shared: str | None = None, **more: str) -> SparkSession:
    """The running session, or a new one; ``shared`` is the folder all executors see, needed on a cluster."""
    conf = SETTINGS | ({"spark.checkpoint.dir": shared} if shared else {}) | more
    spark = SparkSession.builder.appName(app).config(map=conf).getOrCreate()
    for k, v in SETTINGS.items():  # a running session takes them over
        spark.conf.set(k, v)
    return spark
