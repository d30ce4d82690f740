"""History of changing attributes: one change log per attribute, combined into versions.

Snapshots or updates are turned into events (key, attribute, value, time).  Each attribute keeps its
own log, from which values that repeat the one before are taken out, so it has its own intervals.
An entity's versions follow by cutting at the union of its attributes' boundaries, and neighbours
that came out equal are joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.ordering import fill_forward, neighbour
from starloom.operators.standing import standing


def _month(c: str) -> Column:
    """Bucket of a time: a key with a third of all rows is spread over its months."""
    return F.trunc(F.col(c).cast("date"), "month")


def last_loaded(rows: DataFrame, keys: dict[str, Column], at: Column, values: dict[str, Column], loaded: str = "_loaded_at") -> DataFrame:
    """The row of each key and time that was loaded last: keys, ``at`` (timestamp) and values.

    Rows without a key or a time are left out.
    """
    own = {f"__sl_k{i}": c for i, c in enumerate(keys.values())}
    d = rows.select(*(c.alias(k) for k, c in own.items()), at.cast("timestamp_ntz").alias("at"), *(c.alias(v) for v, c in values.items()), F.col(loaded).alias("__sl_loaded"))
    d = d.filter(F.col("at").isNotNull())
    for k in own:
        d = d.filter(F.col(k).isNotNull())
    d = standing(d, [*own, "at"], list(values), "__sl_loaded")
    return d.select(*(F.col(k).alias(n) for k, n in zip(own, keys, strict=True)), "at", *values)


def attribute_log(states: DataFrame, keys: list[str], attributes: dict[str, bool]) -> DataFrame:
    """keys, attribute, value (text), at: the changes of each attribute, one row each.

    states has a key's values at a time, once.  attributes tells whether null is a value; where
    it is not, a null says nothing and the value before goes on.  The first value is a change.
    """
    names = list(attributes)
    pairs = F.explode(F.array(*(F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value"), F.lit(attributes[a]).alias("null_counts")) for a in names)))
    e = states.select(*keys, "at", pairs.alias("p")).select(*keys, "at", "p.*")
    e = e.filter(F.col("null_counts") | F.col("value").isNotNull()).drop("null_counts")
    e = neighbour(e, [*keys, "attribute"], "at", F.col("value"), "__sl_prev", _month("at"))
    same = F.col("__sl_prev").isNotNull() & F.col("__sl_prev.value").eqNullSafe(F.col("value"))
    return e.filter(~same).drop("__sl_prev")


def intervals(log: DataFrame, keys: list[str], end: Column) -> DataFrame:
    """log with valid_from and valid_to (the next change, or ``end``) instead of at."""
    d = neighbour(log, keys, "at", F.col("at"), "__sl_next", _month("at"), following=True)
    return d.withColumnRenamed("at", "valid_from").withColumn("valid_to", F.coalesce("__sl_next.value", end)).drop("__sl_next")


def versions(log: DataFrame, keys: list[str], attributes: list[str], end: Column) -> DataFrame:
    """keys, attributes (text), valid_from, valid_to: from an attribute_log, the entity's versions.

    A version starts wherever an attribute changes; an attribute not yet known is null.
    """
    changed = [F.max(F.when(F.col("attribute") == a, F.struct("value"))).alias(a) for a in attributes]
    cuts = log.groupBy(*keys, "at").agg(*changed)
    full = fill_forward(cuts, keys, "at", attributes, _month("at"))
    full = full.select(*keys, "at", *(F.col(f"{a}.value").alias(a) for a in attributes))
    full = neighbour(full, keys, "at", F.struct(*attributes), "__sl_prev", _month("at"))
    full = full.filter(~F.coalesce(F.col("__sl_prev.value").eqNullSafe(F.struct(*attributes)), F.lit(False))).drop("__sl_prev")
    return intervals(full, keys, end).select(*keys, *attributes, "valid_from", "valid_to")
