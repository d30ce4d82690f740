"""Hot keys: found by a pre-aggregated count, and spread over salts in joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 64
SALTS = 32


def hot_values(df: DataFrame, column: str, share: float = HOT_SHARE) -> list:
    """The values that at least ``share`` of the rows have: at most 1 / share of them, whatever the data."""
    counts = df.groupBy(column).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    rows = counts.filter(F.col(column).isNotNull() & (F.col("count") >= max(2, share * total))).select(column).collect()
    return sorted(r[0] for r in rows)


def _salts(key: Column, hot: list, of_row: Column) -> Column:
    return F.when(key.isin(hot), of_row).otherwise(F.lit(0)) if hot else F.lit(0)


def salt_left(df: DataFrame, key: str, hot: list, spread: Column) -> DataFrame:
    """__sl_salt: for rows of hot keys a salt that follows ``spread``, else 0."""
    return df.withColumn("__sl_salt", _salts(F.col(key), hot, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")))


def salt_right(df: DataFrame, key: str, hot: list) -> DataFrame:
    """Rows of hot keys once for each salt, others once."""
    if not hot:
        return df.withColumn("__sl_salt", F.lit(0))
    every = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("__sl_salt", F.explode(every))


def look_up(left: DataFrame, right: DataFrame, key: str, spread: Column, hot: list | Callable[[], list] | None = None, how: str = "left", broadcast_rows: int = 200_000, rows: int | None = None) -> DataFrame:
    """left joined to right: broadcast if right is small enough, else salted by left's hot keys.  rows: right's rows, where known."""
    from starloom.sources.tables import bounded

    if bounded(right, broadcast_rows) if rows is None else rows <= broadcast_rows:
        return left.join(F.broadcast(right), key, how)
    hot = hot_values(left, key) if hot is None else hot() if callable(hot) else hot
    l, r = salt_left(left, key, hot, spread), salt_right(right, key, hot)
    return l.join(r, [key, "__sl_salt"], how).drop("__sl_salt")


def anti_join(left: DataFrame, right: DataFrame, key: str, spread: Column, condition: Column, hot: Callable[[], list], broadcast_rows: int = 200_000) -> DataFrame:
    """left without the rows for which right, which has each key once, has a row that meets the condition; joined as in look_up."""
    from starloom.sources.tables import bounded

    r = right.withColumnRenamed(key, "__sl_right")
    on = (F.col(key) == F.col("__sl_right")) & condition
    if bounded(right, broadcast_rows):
        return left.join(F.broadcast(r), on, "left_anti")
    values = hot()
    l, r = salt_left(left, key, values, spread), salt_right(r, "__sl_right", values).withColumnRenamed("__sl_salt", "__sl_right_salt")
    return l.join(r, on & (F.col("__sl_salt") == F.col("__sl_right_salt")), "left_anti").drop("__sl_salt")
