"""Filling containers of fixed capacity: shortest-pack-first over the histogram of lengths.

Only the histogram of item lengths reaches the driver, at most one number per length up to the
capacity.  There lengths are placed longest first.  Open packs are kept as groups of equal packs; an
item goes to the group with the most room, where it fits, or opens packs of its own.  A step places
one item in every pack of a group at once, so the work depends on the histogram's shape and not on
how many documents there are.  A step is a rule: the items of one length with ranks r .. r + n - 1
go to packs c .. c + n - 1.  Documents are ranked within their length and find their pack by rank.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.tables import bounded

ROWS_A_BUCKET = 200_000  #: items of one length that one task numbers
BIG = np.int64(1) << 40
SIZES = 100  #: container sizes packed in one pass; more take several
BUCKETS = 100_000  #: most bucket offsets that are broadcast


def shortest_pack_first(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Rules (length, first rank, items, first pack) and the number of packs.

    Every item of every length is placed once; lengths lie in 1 .. capacity.  A step ends a length, moves
    a whole group or opens packs, and only the end of a length splits a group, so there are at most two
    groups per length and as many rules as groups hold items: a bound set by the capacity alone.
    """
    rules: list[tuple[int, int, int, int]] = []
    groups: list[tuple[int, int, int]] = []  # (-room, first pack, packs)
    packs = 0
    for length, left in sorted(zip(lengths.tolist(), counts.tolist(), strict=True), reverse=True):
        rank = 0
        each = capacity // length  # a new pack is the one with the most room until it is full
        while left:
            if groups and -groups[0][0] >= length:
                room, first, n = heapq.heappop(groups)
                if n > left:
                    heapq.heappush(groups, (room, first + left, n - left))
                    n = left
                held = 1
            else:
                n = max(1, left // each)
                held = min(each, left)
                room, first = -capacity, packs
                packs += n
            for _ in range(held):
                rules.append((length, rank, n, first))
                rank += n
            left -= n * held
            room += length * held
            if room:
                heapq.heappush(groups, (room, first, n))
    return np.array(rules, np.int64).reshape(-1, 4), packs


def _sizes(capacities: DataFrame) -> list[list[tuple[str, int]]]:
    """Container names and capacities in blocks of SIZES; of a name listed twice the greater capacity, none without a positive one."""
    c = capacities.filter(F.col("capacity_tokens") > 0).groupBy("container_name").agg(F.max("capacity_tokens").cast("bigint"))
    rows = sorted(((n, k) for n, k in c.toLocalIterator()), key=lambda r: (r[0] or "", r[1]))
    return [rows[i : i + SIZES] for i in range(0, len(rows), SIZES)] or [[]]


def items_of(counts: DataFrame, sizes: list[tuple[str, int]]) -> DataFrame:
    """Each document's items for each container: whole, or cut at every capacity if it is longer.

    Columns: container_name, capacity, doc_id, piece, start_token, tokens.  Documents without
    tokens need no room and have no item.
    """
    every = F.array(*(F.struct(F.lit(n).cast("string").alias("container_name"), F.lit(k).cast("bigint").alias("capacity")) for n, k in sizes or [("", 0)]))
    d = counts.select("doc_id", "tokens").filter(F.col("tokens") > 0).withColumn("__sl_c", F.explode(every)).select("*", "__sl_c.*").filter(F.col("capacity") > 0)
    d = d.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / F.col("capacity")).cast("int"))))
    start = F.col("piece") * F.col("capacity")
    return d.select("container_name", "capacity", "doc_id", "piece", start.alias("start_token"), F.least("capacity", F.col("tokens") - start).alias("tokens"))


def _ranked(spark: SparkSession, items: DataFrame, histogram: pd.DataFrame) -> DataFrame:
    """items with __sl_rank: 0, 1, 2, ... within each container and length.

    A length with more than ROWS_A_BUCKET items is numbered in buckets of that size, so only such
    lengths have offsets to add: one per ROWS_A_BUCKET items, whatever the number of lengths.
    """
    keys = ["container_name", "tokens"]
    hot = histogram[histogram["count"] > ROWS_A_BUCKET]
    item = F.struct("doc_id", "piece")
    if hot.empty:
        return items.withColumn("__sl_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(item)) - 1)
    parts = [(n, int(t), int(-(-c // ROWS_A_BUCKET))) for n, t, c in zip(hot["container_name"], hot["tokens"], hot["count"], strict=True)]
    n = spark.createDataFrame(parts, "container_name string, tokens bigint, __sl_n int")
    d = items.join(F.broadcast(n) if len(parts) <= BUCKETS else n, keys, "left")
    d = d.withColumn("__sl_bucket", F.coalesce(F.pmod(F.xxhash64("doc_id", "piece"), F.col("__sl_n")), F.lit(0)))
    sizes = d.filter(F.col("__sl_n").isNotNull()).groupBy(*keys, "__sl_bucket").count()
    before = Window.partitionBy(*keys).orderBy("__sl_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "__sl_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__sl_before"))
    d = d.withColumn("__sl_rank", F.row_number().over(Window.partitionBy(*keys, "__sl_bucket").orderBy(item)) - 1)
    d = d.join(F.broadcast(sizes) if bounded(sizes, BUCKETS) else sizes, [*keys, "__sl_bucket"], "left")
    return d.withColumn("__sl_rank", F.col("__sl_rank") + F.coalesce("__sl_before", F.lit(0))).drop("__sl_before", "__sl_bucket", "__sl_n")


def pack(spark: SparkSession, counts: DataFrame, capacities: DataFrame) -> DataFrame:
    """container_name, container_no, doc_id, piece, start_token, tokens: the place of every item.

    counts: doc_id (unique) and tokens, read up to four times for every SIZES containers; capacities:
    container_name and capacity_tokens, any number of rows.  Ties in length are broken by document,
    so that equal inputs give equal packs.
    """
    out = None
    for sizes in _sizes(capacities):
        one = _pack(spark, items_of(counts, sizes))
        out = one if out is None else out.unionByName(one)
    return out


def _pack(spark: SparkSession, items: DataFrame) -> DataFrame:
    histogram = items.groupBy("container_name", "capacity", "tokens").count().toPandas()  # a row per length up to the capacity
    rules = {}
    for (name, capacity), h in histogram.groupby(["container_name", "capacity"], dropna=False):
        r, _ = shortest_pack_first(h["tokens"].to_numpy(np.int64), h["count"].to_numpy(np.int64), int(capacity))
        at = np.lexsort((r[:, 1], r[:, 0]))
        rules[name if isinstance(name, str) else None] = r[at]
    shared = spark.sparkContext.broadcast(rules)

    def place(names: pd.Series, lengths: pd.Series, ranks: pd.Series) -> pd.Series:
        no = np.empty(len(names), np.int64)
        for name, at in names.groupby(names, dropna=False).indices.items():
            r = shared.value[name if isinstance(name, str) else None]
            length, rank = lengths.to_numpy(np.int64)[at], ranks.to_numpy(np.int64)[at]
            # rules are sorted by (length, first rank); the last one not beyond (length, rank) holds it
            i = np.searchsorted(r[:, 0] * BIG + r[:, 1], length * BIG + rank, side="right") - 1
            no[at] = r[i, 3] + rank - r[i, 1]
        return pd.Series(no)

    no = F.pandas_udf(place, T.LongType())("container_name", "tokens", "__sl_rank").alias("container_no")
    return _ranked(spark, items, histogram).select("container_name", no, "doc_id", "piece", "start_token", "tokens")


def broken(packed: DataFrame, counts: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per container size: documents packed, overfull containers, documents that lack tokens, and documents cut though they fit; the last three must be 0."""
    c = capacities.groupBy("container_name").agg(F.max("capacity_tokens").cast("bigint").alias("__sl_room"))
    over = packed.groupBy("container_name", "container_no").agg(F.sum("tokens").alias("n")).join(c, "container_name").groupBy("container_name").agg(F.count_if(F.col("n") > F.col("__sl_room")).alias("overfull"))
    docs = packed.groupBy("container_name", "doc_id").agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("pieces")).join(counts.select("doc_id", F.col("tokens").alias("__sl_all")), "doc_id").join(c, "container_name")
    per = docs.groupBy("container_name").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("n") != F.col("__sl_all")).alias("incomplete"), F.count_if((F.col("pieces") > 1) & (F.col("__sl_all") <= F.col("__sl_room"))).alias("cut_needlessly"))
    return per.join(over, "container_name").select("container_name", "documents", "overfull", "incomplete", "cut_needlessly")


def fill(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per container size: items, containers, tokens, the share of room used and the least number of containers there could be."""
    c = capacities.groupBy("container_name").agg(F.max("capacity_tokens").cast("bigint").alias("capacity_tokens"))
    p = packed.groupBy("container_name").agg(F.count(F.lit(1)).alias("items"), (F.max("container_no") + 1).alias("containers"), F.sum("tokens").alias("tokens"))
    room = F.col("containers") * F.col("capacity_tokens")
    return p.join(F.broadcast(c), "container_name").select(
        "container_name", "capacity_tokens", "items", "containers", "tokens", F.round(F.col("tokens") / room, 6).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers")
    )
