"""Reconciliation, integrity and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and actual rows of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(name).alias("table_name"), "actual")
        out = one if out is None else out.unionByName(one)
    return out


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """table_name, expected, actual, status: OK or MISMATCH; a table on one side only has 0 on the other."""
    d = actual.join(expected, "table_name", "full_outer").select("table_name", F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual"))
    return d.withColumn("status", F.when(F.col("expected") == F.col("actual"), "OK").otherwise("MISMATCH"))


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of both sides, their difference and their common keys."""
    common = left.select(key).intersect(right.select(key)).agg(F.count(F.lit(1)).alias("in_both"))
    l, r = left.agg(F.count(F.lit(1)).alias("batch_rows")), right.agg(F.count(F.lit(1)).alias("stream_rows"))
    one = lambda d: d.withColumn("__sl_one", F.lit(1))
    d = one(l).join(one(r), "__sl_one").join(one(common), "__sl_one")
    return d.select("batch_rows", "stream_rows", (F.col("stream_rows") - F.col("batch_rows")).alias("delta"), "in_both")


def drift(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer comparison: key and status 'batch only', 'stream only' or 'differs'; equal rows are left out."""
    l = left.select(F.col(key).alias("__sl_l"), F.struct(*fields).alias("__sl_lv"))
    r = right.select(F.col(key).alias("__sl_r"), F.struct(*fields).alias("__sl_rv"))
    d = l.join(r, F.col("__sl_l").eqNullSafe(F.col("__sl_r")), "full_outer")
    status = F.when(F.col("__sl_rv").isNull(), "batch only").when(F.col("__sl_lv").isNull(), "stream only").when(~F.col("__sl_lv").eqNullSafe(F.col("__sl_rv")), "differs")
    return d.select(F.coalesce("__sl_l", "__sl_r").alias(key), status.alias("status")).filter(F.col("status").isNotNull())
