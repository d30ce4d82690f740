"""Running sums, ranks and neighbours without one task per key.

A window over a key puts all of its rows into one task.  Here a key's rows are first cut into
buckets that follow the order; the window runs within a bucket, and what a bucket needs from those
before it (a sum, a last value) is carried over by a second window over one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys: list[str], order: list[Column | str], value: str, out: str, bucket: Column) -> DataFrame:
    """df with out: the sum of value over the rows of the key up to and with this one.

    bucket must not fall as the order rises.  order must be unique within a key for a result
    that does not depend on the order of rows; rows equal in it are summed in any order.
    Null values add nothing.
    """
    d = df.withColumn("__sl_bucket", bucket)
    w = Window.partitionBy(*keys, "__sl_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
    sums = df.withColumn("__sl_bucket", bucket).groupBy(*keys, "__sl_bucket").agg(F.coalesce(F.sum(value), F.lit(0)).alias("__sl_all"))
    before = Window.partitionBy(*keys).orderBy("__sl_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(k).alias(f"__sl_{k}") for k in keys), F.col("__sl_bucket").alias("__sl_b"), F.coalesce(F.sum("__sl_all").over(before), F.lit(0)).alias("__sl_before"))
    on = F.col("__sl_bucket").eqNullSafe(F.col("__sl_b"))
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__sl_{k}"))
    return d.join(sums, on).withColumn(out, F.col(out) + F.col("__sl_before")).select(*df.columns, out)


def rank_within(df: DataFrame, keys: list[str], order: str, out: str, buckets: int) -> DataFrame:
    """df with out: 0, 1, 2, ... within each key, ordered by (hash bucket of order, order).

    The ranks are dense and repeatable but follow the hash, so a hot key is numbered by
    ``buckets`` tasks at once.
    """
    d = df.withColumn("__sl_bucket", F.pmod(F.xxhash64(order), F.lit(buckets)))
    w = Window.partitionBy(*keys, "__sl_bucket").orderBy(order)
    d = d.withColumn(out, F.row_number().over(w) - 1)
    counts = df.withColumn("__sl_bucket", F.pmod(F.xxhash64(order), F.lit(buckets))).groupBy(*keys, "__sl_bucket").count()
    before = Window.partitionBy(*keys).orderBy("__sl_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(k).alias(f"__sl_{k}") for k in keys), F.col("__sl_bucket").alias("__sl_b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__sl_before"))
    on = F.col("__sl_bucket") == F.col("__sl_b")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__sl_{k}"))
    return d.join(counts, on).withColumn(out, (F.col(out) + F.col("__sl_before")).cast("bigint")).select(*df.columns, out)


def neighbour(df: DataFrame, keys: list[str], order: str, value: Column, out: str, bucket: Column, following: bool = False) -> DataFrame:
    """df with out: a struct holding the value of the row before (or after) in the key; null at its end.

    A struct, so that a null value and no row differ.  bucket must not fall as the order rises,
    which must be unique within a key.
    """
    d = df.withColumn("__sl_bucket", bucket).withColumn("__sl_value", F.struct(value.alias("value")))
    inner = Window.partitionBy(*keys, "__sl_bucket").orderBy(F.col(order).desc() if following else F.col(order))
    d = d.withColumn(out, F.lag("__sl_value").over(inner))
    last = (F.min_by if following else F.max_by)("__sl_value", order)
    edge = d.groupBy(*keys, "__sl_bucket").agg(last.alias("__sl_last"))
    outer = Window.partitionBy(*keys).orderBy(F.col("__sl_bucket").desc() if following else F.col("__sl_bucket"))
    edge = edge.select(*keys, "__sl_bucket", F.lag("__sl_last").over(outer).alias("__sl_carried"))
    return d.join(edge, [*keys, "__sl_bucket"]).withColumn(out, F.coalesce(out, "__sl_carried")).select(*df.columns, out)


def fill_forward(df: DataFrame, keys: list[str], order: str, columns: list[str], bucket: Column) -> DataFrame:
    """df with the nulls of each column replaced by the last value before in the key that is not null."""
    d = df.withColumn("__sl_bucket", bucket)
    inner = Window.partitionBy(*keys, "__sl_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(*keys, order, "__sl_bucket", *(c for c in df.columns if c not in [*keys, order, *columns]), *(F.last(c, ignorenulls=True).over(inner).alias(c) for c in columns))
    edge = d.groupBy(*keys, "__sl_bucket").agg(*(F.max_by(c, order).alias(f"__sl_{c}") for c in columns))
    outer = Window.partitionBy(*keys).orderBy("__sl_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select(*keys, "__sl_bucket", *(F.last(f"__sl_{c}", ignorenulls=True).over(outer).alias(f"__sl_{c}") for c in columns))
    d = d.join(edge, [*keys, "__sl_bucket"])
    return d.select(*(F.coalesce(c, f"__sl_{c}").alias(c) if c in columns else F.col(c) for c in df.columns))
