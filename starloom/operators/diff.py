"""Differences between two copies of a table, by presence bitmaps and ordinal-aligned columns.

1. Every key of either copy gets an ordinal that both share: the hash bucket of the key and its rank
   among the bucket's keys.  Only keys and a 128-bit hash of each row's fields are shuffled for it.
2. Each range of 2^15 ordinals holds, of either copy, a compressed presence bitmap and the column of
   row hashes in the order of ordinals.  AND-NOT of the bitmaps gives the rows a copy lacks; where
   both bits are set, the aligned hashes tell which rows differ at all.
3. The few surviving ordinals are decoded to keys, and only the rows of those that differ are read
   again and compared field by field.

A range is bounded by its ordinals, so no task holds more than 2 x 2^15 hashes at a time, however many
rows the tables have.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.bitmaps import RANGE, RANGE_BITS, and_, and_not, pack, unpack
from starloom.sources.tables import Scratch, bounded

LEFT_ONLY, RIGHT_ONLY, BOTH = "batch only", "stream only", "both"
ROWS_A_BUCKET = 20_000
CASES = 200_000  #: keys with a difference up to which they are broadcast


def _sides(left: DataFrame, right: DataFrame, key: str, fields: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """key and fields of either copy as text; rows without a key name none and are left out."""
    return tuple(t.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), *(c.cast("string").alias(f) for f, c in fields.items())) for t in (left, right))


def _hash(fields: list[str]) -> Column:
    """128 bits of a row's fields as two numbers, from two hashes of which one has another start."""
    return F.struct(F.xxhash64(*fields).alias("a"), F.xxhash64(F.lit(len(fields)), *reversed(fields), F.lit("|")).alias("b"))


def ordinals(left: DataFrame, right: DataFrame, fields: list[str], buckets: int) -> DataFrame:
    """side (0 left, 1 right), key, row hash, and range and bit of the key's ordinal."""
    rows = left.select(F.lit(0).alias("side"), "key", _hash(fields).alias("h")).unionByName(right.select(F.lit(1).alias("side"), "key", _hash(fields).alias("h")))
    rows = rows.withColumn("__sl_bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    rows = rows.withColumn("__sl_rank", F.dense_rank().over(Window.partitionBy("__sl_bucket").orderBy("key")) - 1)
    # up to 2^24 ranges a bucket
    at = (F.col("__sl_bucket").cast("bigint") * (1 << 24) + F.shiftright("__sl_rank", RANGE_BITS)).alias("range")
    return rows.select("side", "key", "h", at, F.pmod("__sl_rank", F.lit(RANGE)).cast("bigint").alias("bit"))


def _ranges(rows: DataFrame) -> DataFrame:
    """For each range the presence bitmap of either copy and its row hashes in the order of ordinals."""
    out = []
    for side, name in ((0, "left"), (1, "right")):
        mine = F.col("side") == side
        out += [F.bitmap_construct_agg(F.when(mine, F.col("bit"))).alias(name), F.sort_array(F.collect_list(F.when(mine, F.struct("bit", "h.a", "h.b")))).alias(f"{name}_rows")]
    d = rows.groupBy("range").agg(*out)
    column = lambda name, c: F.transform(f"{name}_rows", lambda x: x[c]).alias(f"{name}_{c}")
    return d.select("range", "left", "right", *(column(n, c) for n in ("left", "right") for c in "ab"))


def _compared(row: tuple) -> tuple[bytes, bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Packed bitmaps of a range, the bits each copy alone has, and the bits of both whose rows differ."""
    left, right, la, lb, ra, rb = row
    l, r = pack(unpack(left)), pack(unpack(right))
    both = and_(l, r)
    # the n-th set bit of a bitmap has the n-th hash
    i, j = np.searchsorted(unpack(left), both), np.searchsorted(unpack(right), both)
    differ = (np.asarray(la, np.int64)[i] != np.asarray(ra, np.int64)[j]) | (np.asarray(lb, np.int64)[i] != np.asarray(rb, np.int64)[j])
    return l, r, and_not(l, r), and_not(r, l), both[differ]


_COLUMNS = ["left", "right", "left_a", "left_b", "right_a", "right_b"]


def _struct(names: list[str], type_: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, type_) for n in names])


_KINDS = ["left_only", "right_only", "both"]
_SIZES = ["left_rows", "right_rows", "in_both", "left_only", "right_only", "differing", "bitmap_bytes"]


@F.pandas_udf(_struct(_KINDS, T.ArrayType(T.LongType())))
def _cases(left: pd.Series, right: pd.Series, la: pd.Series, lb: pd.Series, ra: pd.Series, rb: pd.Series) -> pd.DataFrame:
    said = [_compared(x)[2:] for x in zip(left, right, la, lb, ra, rb, strict=True)]
    return pd.DataFrame({n: pd.Series([x[k] for x in said], dtype=object) for k, n in enumerate(_KINDS)})


@F.pandas_udf(_struct(_SIZES, T.LongType()))
def _sizes(left: pd.Series, right: pd.Series, la: pd.Series, lb: pd.Series, ra: pd.Series, rb: pd.Series) -> pd.DataFrame:
    out = []
    for x in zip(left, right, la, lb, ra, rb, strict=True):
        l, r, only_l, only_r, differ = _compared(x)
        out.append((len(x[2]), len(x[4]), len(x[2]) - len(only_l), len(only_l), len(only_r), len(differ), len(l) + len(r)))
    return pd.DataFrame(out, columns=_SIZES)


def _buckets(left: DataFrame, right: DataFrame) -> int:
    n = left.agg(F.count(F.lit(1))).unionByName(right.agg(F.count(F.lit(1))))
    total = sum(r[0] for r in n.collect())  # two numbers
    return max(1, -(-total // ROWS_A_BUCKET))


def differences(spark: SparkSession, left: DataFrame, right: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """key, field_name, left_value, right_value: a row for each key one copy lacks and each differing field.

    Each copy must have a key once and is read three times.  Fields are compared as text after the
    given expressions, which must give no null.  Null keys are left out: they name no row.  Extra
    columns are not read.
    """
    scratch = Scratch(spark)
    l, r = _sides(left, right, key, fields)
    names = list(fields)
    told = scratch.put(ordinals(l, r, names, _buckets(l, r)))
    c = _ranges(told).select("range", _cases(*_COLUMNS).alias("c"))
    kinds = F.array(*(F.struct(F.lit(n).alias("kind"), F.col(f"c.{x}").alias("bits")) for n, x in ((LEFT_ONLY, "left_only"), (RIGHT_ONLY, "right_only"), (BOTH, "both"))))
    c = scratch.put(c.select("range", F.explode(kinds).alias("k")).select("range", "k.kind", F.explode("k.bits").alias("bit")))
    small = bounded(c, CASES)
    near = F.broadcast if small else (lambda d: d)
    keys = told.select("range", "bit", "key").join(near(c), ["range", "bit"]).select("key", "kind").distinct()
    keys = scratch.put(keys)
    nothing = F.lit(None).cast("string")
    missing = keys.filter(F.col("kind") != BOTH).select("key", F.col("kind").alias("field_name"), nothing.alias("left_value"), nothing.alias("right_value"))
    differ = keys.filter(F.col("kind") == BOTH).select("key")
    a, b = (t.join(near(differ), "key", "left_semi").select("key", F.array(*names).alias(n)) for t, n in ((l, "__sl_l"), (r, "__sl_r")))
    pairs = a.join(b, "key").select("key", F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("f"), F.col("__sl_l"), F.col("__sl_r"))).alias("v"))
    values = pairs.select("key", F.col("v.f").alias("field_name"), F.col("v.__sl_l").alias("left_value"), F.col("v.__sl_r").alias("right_value"))
    return missing.unionByName(values.filter(F.col("left_value") != F.col("right_value")))


def range_counts(left: DataFrame, right: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """For each range of ordinals the rows of either copy, in both, missing and differing, and the size of its bitmaps."""
    l, r = _sides(left, right, key, fields)
    return _ranges(ordinals(l, r, list(fields), _buckets(l, r))).select("range", _sizes(*_COLUMNS).alias("n")).select("range", "n.*")
