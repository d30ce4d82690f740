"""Building and maintaining header/line facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contract import Dimension
from starloom.functions.values import date_key, net_amount
from starloom.operators import keys as key_ops
from starloom.operators.changefeed import DELETE
from starloom.operators.standing import standing
from starloom.sources.tables import Scratch


def build(headers: DataFrame, lines: DataFrame, on: str) -> DataFrame:
    """Line grain: each line with the columns of its header; lines without header and headers without lines are left out."""
    return lines.join(headers, on)


def stitch(headers: DataFrame, lines: DataFrame, on: str) -> DataFrame:
    """Like build, but a line that came before its header stays, with has_header 0 and nulls."""
    h = headers.withColumn("__sl_has", F.lit(1))
    return lines.join(h, on, "left").withColumn("has_header", F.coalesce("__sl_has", F.lit(0))).drop("__sl_has")


def header_fan_out(headers: DataFrame, changed: DataFrame, lines: DataFrame, on: str) -> DataFrame:
    """All lines of changed headers, rebuilt."""
    return build(headers.join(changed.select(on).distinct(), on, "left_semi"), lines, on)


def line_side(headers: DataFrame, changed_lines: DataFrame, on: str) -> DataFrame:
    """Changed lines with their headers."""
    return build(headers, changed_lines, on)


def tombstones(facts: DataFrame, deleted: DataFrame, on: str, version: Column) -> DataFrame:
    """Rows that delete all lines of deleted headers: the standing rows with is_deleted 1 and a new version."""
    gone = facts.join(deleted.select(on).distinct(), on, "left_semi")
    return gone.withColumn("is_deleted", F.lit(1)).withColumn("_version", version.cast("bigint"))


def affected(changes: DataFrame, on: str, operation: str = "operation") -> DataFrame:
    """Keys whose rows must be read again: those changed but not deleted last."""
    last = changes.groupBy(on).agg(F.max_by(operation, "_version").alias("__sl_op"))
    return last.filter(F.col("__sl_op") != DELETE).select(on)


def snapshot(source: DataFrame, keys: DataFrame | None, on: str) -> DataFrame:
    """All rows without a list of keys; only those of the list with one, and none for an empty list."""
    return source if keys is None else source.join(keys.select(on).distinct(), on, "left_semi")


def apply(facts: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    """The facts after appending rows: the standing row of each key."""
    values = [c for c in facts.columns if c not in [*keys, "_version"]]
    return standing(facts.unionByName(written), keys, [*values, "_version"]).select(*facts.columns)


def bridge(pairs: DataFrame, left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Distinct pairs of which both sides are known."""
    return pairs.join(left.select(left_on), left_on, "left_semi").join(right.select(right_on), right_on, "left_semi").select(left_on, right_on).distinct()


@dataclass(frozen=True)
class Reference:
    """A dimension that facts refer to by ``column``: its contract, its open rows, and the highest surrogate key of all its rows."""

    column: str
    dimension: Dimension
    open_rows: DataFrame
    highest: int


def resolve_references(spark: SparkSession, facts: DataFrame, references: list[Reference], at: Column, version: Column) -> tuple[DataFrame, dict[str, DataFrame]]:
    """facts with the surrogate key of each reference, and the members that had to be inferred for it, by table.

    A key that the dimension lacks gets an inferred member, to be written before the facts; null and 0
    refer to nothing and give 0.
    """
    scratch, inferred, unresolved = Scratch(spark), {}, facts
    for r in references:
        d = r.dimension
        missing = key_ops.missing_keys(unresolved.select(r.column), r.open_rows, r.column, d.alternate)  # one column of the source, no join before it
        inferred[d.table] = scratch.put(key_ops.stubs(d, missing, r.highest, at, version))
        known = r.open_rows.select(d.alternate, F.col(d.surrogate).cast("bigint").alias(d.surrogate))
        known = known.unionByName(inferred[d.table].select(F.col(d.alternate).cast(known.schema[d.alternate].dataType).alias(d.alternate), d.surrogate))
        facts = key_ops.resolve(facts, known, r.column, d.alternate, d.surrogate, d.surrogate)
    return facts, inferred


def load(spark: SparkSession, headers: DataFrame, lines: DataFrame, on: str, references: list[Reference], geography: DataFrame, address: dict[str, str], dates: list[str], at: Column, version: Column) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact rows from headers and lines, and the inferred members they need.

    Each line with its header, the surrogate key of every reference, geography_key by the address
    columns (0 where no address is alike), a smart key for each date, line_total, is_deleted 0 and the
    version.  Lines without header are left out; headers without lines give nothing.
    """
    d, inferred = resolve_references(spark, build(headers, lines, on), references, at, version)
    d = key_ops.resolve_tuple(d, geography, address, "geography_key", "geography_key")
    d = d.withColumns({f"{c}_key": date_key(F.col(c)) for c in dates})
    total = net_amount(F.col("unit_price"), F.col("quantity"), F.col("discount"))
    d = d.withColumns({"line_total": total, "is_deleted": F.lit(0), "_version": version.cast("bigint")})
    return d.drop(*(r.column for r in references if r.column != on), *address), inferred


def incremental(facts: DataFrame, changes: DataFrame, headers: DataFrame, lines: DataFrame, on: str, keys: list[str], rebuild: Callable[[DataFrame, DataFrame], DataFrame], version: Column) -> DataFrame:
    """Rows to append for a window of changes: tombstones and rebuilt lines, in the columns of facts.

    changes: ``on``, operation, _version.  An order whose last change is a delete loses all its standing
    lines.  Every other changed order is read again from headers and lines and rebuilt; lines it no longer
    has are tombstones too.  The watermark is to be advanced after these rows are written; applying a
    window again appends rows equal in key and version.
    """
    again = affected(changes, on)
    gone = changes.select(on).distinct().join(again, on, "left_anti")
    new = rebuild(snapshot(headers, again, on), snapshot(lines, again, on)).select(*facts.columns)
    new = Scratch(facts.sparkSession).put(new)
    left = facts.filter(F.coalesce("is_deleted", F.lit(0)) == 0)
    lost = left.join(again, on, "left_semi").join(new.select(*keys), keys, "left_anti")
    dead = tombstones(left, gone, on, version).unionByName(lost.withColumns({"is_deleted": F.lit(1), "_version": version.cast("bigint")}))
    return new.unionByName(dead.select(*facts.columns))
