"""Version collapse: the standing row of each key, live rows, open rows.

Warehouse tables are append-only: a change is a new row with a higher version, a deletion a row
with a tombstone flag.  Readers collapse them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: End of a version that is still valid (fixed value).
OPEN_END = datetime.datetime(2106, 1, 1)


def open_end() -> Column:
    return F.lit("2106-01-01 00:00:00").cast("timestamp_ntz")


def standing(df: DataFrame, keys: dict[str, Column] | list[str], values: list[str], version: str | Column = "_version") -> DataFrame:
    """For each key the values of the row with the highest version: columns ``keys`` and ``values``.

    Rows are combined before the shuffle, so a key that holds a third of all rows arrives as one
    row per map task.  Null keys are a key of their own; a null version is the lowest.  Of rows with
    equal version the one with the greatest values (in the order given) stands, so the result does
    not depend on the order of rows.  No rows give no rows; other columns are not carried.
    """
    keys = {k: F.col(k) for k in keys} if isinstance(keys, list) else keys
    rank = F.col(version) if isinstance(version, str) else version
    best = F.max(F.struct(rank.alias("__sl_v"), *(F.col(v) for v in values))).alias("__sl_best")
    out = df.groupBy(*(c.alias(k) for k, c in keys.items())).agg(best)
    return out.select(*keys, *(F.col(f"__sl_best.{v}").alias(v) for v in values))


def live(df: DataFrame, keys: list[str], values: list[str], version: str = "_version", deleted: str = "is_deleted") -> DataFrame:
    """The standing rows that are no tombstones.  A null flag is no tombstone."""
    columns = list(dict.fromkeys([*values, deleted]))
    out = standing(df, keys, columns, version).filter(F.coalesce(F.col(deleted), F.lit(0)) == 0)
    return out.select(*keys, *values)


def current(df: DataFrame, keys: dict[str, Column], values: list[str], version: str = "_version") -> DataFrame:
    """For each key its open standing row; of several open ones the one that started last."""
    own = list(dict.fromkeys([*values, "end_date"]))
    rows = standing(df, keys | {"__sl_start": F.col("start_date")}, own, version)
    rows = rows.filter(F.col("end_date") == open_end())
    return standing(rows, list(keys), values, "__sl_start")
