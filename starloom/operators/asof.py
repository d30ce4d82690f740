"""Attributes as known at event time: validity intervals as dyadic time nodes.

Time is cut into cells (days) and nodes of 8, 64, 512, ... cells: every third level of the dyadic
tree.  An interval is covered by a few nodes, each as large as fits, and an event lies in exactly
one node of each level.  So interval containment is an equality join on (entity, level, node), with
no range condition to spread over all pairs of an entity.  Cells at an interval's ends are covered
whole; the exact half-open test follows.  Of several versions that hold, the one that started last
wins, then the one with the highest version, then with the greatest key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import epoch_micros
from starloom.operators.skew import hot_values, salt_left, salt_right

CELL = 86_400 * 1_000_000
STRIDE = 3


def levels_for(cells: int) -> int:
    """The number of levels, so that at most 8 nodes of the highest span all cells."""
    n = 1
    while (1 << (STRIDE * n)) < cells:
        n += 1
    return n


def _range(a: Column, b: Column, level: int) -> Column:
    nodes = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
    return F.transform(nodes, lambda n: F.struct(F.lit(level).alias("level"), n.alias("node")))


def cover(a: Column, b: Column, levels: int) -> Column:
    """Nodes that together are exactly the cells a .. b - 1, each cell in one of them."""
    parts = []
    for k in range(levels):
        size, up = 1 << (STRIDE * k), 1 << STRIDE
        first, last = F.floor((a + (size - 1)) / F.lit(size)).cast("bigint"), F.floor(b / F.lit(size)).cast("bigint")
        if k == levels - 1:
            parts.append(_range(first, last, k))
            continue
        nfirst, nlast = F.floor((first + (up - 1)) / F.lit(up)).cast("bigint"), F.floor(last / F.lit(up)).cast("bigint")
        some = nfirst < nlast
        parts.append(_range(first, F.when(some, nfirst * up).otherwise(last), k))
        parts.append(_range(F.when(some, nlast * up).otherwise(last), last, k))
    return F.concat(*parts)


def _span(events: DataFrame, at: str) -> tuple[int, int] | None:
    lo, hi = events.agg(F.min(epoch_micros(F.col(at))), F.max(epoch_micros(F.col(at)))).first()
    return None if lo is None else (lo // CELL, hi // CELL + 1)


def matches(events: DataFrame, versions: DataFrame, entity: str, at: str, spread: Column) -> DataFrame:
    """Each event with each version of its entity that holds at its time.

    events: entity, at and more; versions: entity, start_date, end_date (null: open) and more, with
    no other name in common.  Events without entity or time match nothing, as do versions that end
    before they start.  events is read three times, so it should be a written table.
    """
    e = events.filter(F.col(entity).isNotNull() & F.col(at).isNotNull())
    payload = [c for c in versions.columns if c != entity]
    span = _span(e, at)
    lo, hi = span or (0, 1)
    levels = levels_for(hi - lo)
    a = F.greatest(F.floor(epoch_micros(F.col("start_date")) / F.lit(CELL)).cast("bigint") - lo, F.lit(0))
    b = F.least(F.ceil(F.coalesce(epoch_micros(F.col("end_date")), F.lit(hi * CELL)) / F.lit(CELL)).cast("bigint") - lo, F.lit(hi - lo))
    v = versions.withColumns({"__sl_a": a, "__sl_b": b}).filter(F.col("__sl_a") < F.col("__sl_b"))
    v = v.select(entity, *payload, F.explode(cover(F.col("__sl_a"), F.col("__sl_b"), levels)).alias("__sl_n"))
    v = v.select(entity, *payload, "__sl_n.level", "__sl_n.node").withColumnsRenamed({"level": "__sl_level", "node": "__sl_node"})
    cell = F.floor(epoch_micros(F.col(at)) / F.lit(CELL)).cast("bigint") - lo
    own = F.array(*(F.struct(F.lit(k).alias("level"), F.floor(cell / F.lit(1 << (STRIDE * k))).cast("bigint").alias("node")) for k in range(levels)))
    hot = hot_values(e, entity)
    x = salt_left(e, entity, hot, spread).withColumn("__sl_n", F.explode(own))
    x = x.select(*e.columns, "__sl_salt", F.col("__sl_n.level").alias("__sl_level"), F.col("__sl_n.node").alias("__sl_node"))
    found = x.join(salt_right(v, entity, hot), [entity, "__sl_salt", "__sl_level", "__sl_node"])
    holds = (F.col("start_date") <= F.col(at)) & (F.col("end_date").isNull() | (F.col(at) < F.col("end_date")))
    return found.filter(holds).drop("__sl_salt", "__sl_level", "__sl_node")


def as_of(events: DataFrame, versions: DataFrame, id_columns: list[str], entity: str, at: str, values: list[str], version: str = "_version") -> DataFrame:
    """events with the values of the version that holds at their time; null where none does.

    id_columns must tell events apart; an event is never dropped and never doubled.
    """
    kept = [c for c in events.columns if c not in id_columns]
    v = versions.select(entity, "start_date", "end_date", F.col(version).alias("__sl_version"), *(F.col(c).alias(f"__sl_{c}") for c in values))
    spread = F.concat_ws("|", *(F.col(c).cast("string") for c in id_columns))
    m = matches(events.select(*dict.fromkeys([*id_columns, entity, at])), v, entity, at, spread)
    best = F.struct("start_date", "__sl_version", *(f"__sl_{c}" for c in values))
    both = events.select(*id_columns, F.struct(*kept).alias("__sl_own"), F.lit(None).cast(m.select(best).schema[0].dataType).alias("__sl_best"))
    nothing = F.lit(None).cast(both.schema["__sl_own"].dataType)
    both = both.unionByName(m.select(*id_columns, nothing.alias("__sl_own"), best.alias("__sl_best")))
    out = both.groupBy(*id_columns).agg(F.max("__sl_own").alias("__sl_own"), F.max("__sl_best").alias("__sl_best"))
    return out.select(*id_columns, *(F.col(f"__sl_own.{c}").alias(c) for c in kept), F.col("__sl_best").isNotNull().alias("found"), *(F.col(f"__sl_best.__sl_{c}").alias(c if c not in kept else f"valid_{c}") for c in values))
