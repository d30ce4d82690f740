"""Surrogate keys, key look-ups and inferred members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.contract import Dimension
from starloom.functions.values import zero
from starloom.operators.ordering import rank_within
from starloom.operators.skew import look_up
from starloom.operators.standing import open_end


def highest_key(table: DataFrame, key: str) -> int:
    """The highest surrogate key of all versions; 0 for an empty table."""
    return table.agg(F.max(key)).first()[0] or 0


def assign_keys(rows: DataFrame, natural: str, out: str, after: int | Column = 0, buckets: int = 64) -> DataFrame:
    """rows with a dense surrogate key in ``out``, starting after ``after``.

    Keys follow the hash of the natural key, which must be unique: the same rows get the same keys
    in any order, and numbering runs in ``buckets`` tasks instead of one.
    """
    d = rank_within(rows.withColumn("__sl_all", F.lit(0)), ["__sl_all"], natural, "__sl_rank", buckets)
    return d.select(*rows.columns, (F.lit(after) + 1 + F.col("__sl_rank")).cast("bigint").alias(out))


def assign_keys_ordered(rows: DataFrame, order: list[str], out: str, after: int = 0) -> DataFrame:
    """Like assign_keys, numbered in the natural order: for small tables such as an address dimension only."""
    return rows.withColumn(out, (F.row_number().over(Window.orderBy(*order)) + after).cast("bigint"))


def resolve(facts: DataFrame, dimension: DataFrame, on: str, alternate: str, key: str, out: str, default: int = 0, spread: Column | None = None) -> DataFrame:
    """facts with the surrogate key of ``on``, or ``default`` where there is none.

    dimension: open rows only, each alternate key once; of repeated ones the highest key counts.
    """
    found = dimension.groupBy(F.col(alternate).alias(on)).agg(F.max(key).alias("__sl_key"))
    d = look_up(facts, found, on, spread if spread is not None else F.monotonically_increasing_id())
    return d.withColumn(out, F.coalesce("__sl_key", F.lit(default)).cast("bigint")).select(*facts.columns, out)


def resolve_tuple(facts: DataFrame, dimension: DataFrame, pairs: dict[str, str], key: str, out: str) -> DataFrame:
    """Like resolve, on several columns (an address); null equals the empty text on either side."""
    one = lambda names: F.concat_ws("\x1f", *(F.coalesce(F.rtrim(F.col(n).cast("string")), F.lit("")) for n in names))
    f = facts.withColumn("__sl_on", one(pairs))
    d = dimension.select(one(pairs.values()).alias("__sl_alternate"), F.col(key).alias("__sl_k"))
    return resolve(f, d, "__sl_on", "__sl_alternate", "__sl_k", out).select(*facts.columns, out)


def missing_keys(facts: DataFrame, dimension: DataFrame, on: str, alternate: str) -> DataFrame:
    """Distinct values of ``on`` that the dimension doesn't have; null and 0 refer to nothing."""
    wanted = facts.filter(F.col(on).isNotNull() & (F.col(on).cast("string") != "0")).select(F.col(on).alias(alternate)).distinct()
    return wanted.join(dimension.select(alternate).distinct(), alternate, "left_anti")


def stubs(dimension: Dimension, missing: DataFrame, after: int | Column, at: Column, version: Column) -> DataFrame:
    """Inferred members: open rows with the alternate key, zero values elsewhere and is_inferred set, so that the first real row overwrites them."""
    d = assign_keys(missing.select(dimension.alternate), dimension.alternate, dimension.surrogate, after)
    values = [zero(f.dataType).alias(f.name) for f in dimension.schema]
    dates = [at.alias("start_date"), open_end().alias("end_date")] if dimension.has_history else []
    return d.select(dimension.surrogate, dimension.alternate, *values, *dates, F.lit(1).alias("is_inferred"), version.cast("bigint").alias("_version"))


def hierarchy_keys(employees: DataFrame, key: str, alternate: str, parent_alternate: str, out: str) -> DataFrame:
    """Open rows with the surrogate key of the manager's open row; 0 without one."""
    boss = employees.groupBy(F.col(alternate).alias(parent_alternate)).agg(F.max(key).alias("__sl_boss"))
    d = look_up(employees, boss, parent_alternate, F.col(key))
    return d.withColumn(out, F.coalesce("__sl_boss", F.lit(0))).select(*[c for c in employees.columns if c != out], out)
