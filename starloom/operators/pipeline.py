"""Running a warehouse: change windows and gaps, run log, audit index, seeding, load order."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.standing import standing


def unread(changes: DataFrame, state: DataFrame, source: str, position: str, last: str) -> DataFrame:
    """The changes of each active source after the last position read of it; all of a source that was never read.

    A source not in the state has none.  No position is fetched: the state is joined, being a row for each source.
    """
    s = state.groupBy(F.col(source).alias("__sl_source")).agg(F.max(last).alias("__sl_last"))
    d = changes.join(s, F.col(source) == F.col("__sl_source"))
    return d.filter(F.col("__sl_last").isNull() | (F.col(position) > F.col("__sl_last"))).select(*changes.columns)


def read_upto(window: DataFrame, state: DataFrame, source: str, position: str, last: str) -> DataFrame:
    """The state after a window was applied: the last position of what was read, else the one before."""
    w = window.groupBy(F.col(source).alias("__sl_source")).agg(F.max(position).alias("__sl_upto"))
    d = state.join(w, F.col(source) == F.col("__sl_source"), "left")
    return d.withColumn(last, F.coalesce("__sl_upto", last)).select(*state.columns)


def position_times(changes: DataFrame, position: str, at: str) -> DataFrame:
    """position, at: when each position was committed; of a transaction's differing times the last."""
    return changes.filter(F.col(position).isNotNull()).groupBy(position).agg(F.max(at).alias(at))


def gaps(kept: DataFrame, state: DataFrame, source: str, position: str, last: str) -> DataFrame:
    """Sources whose oldest change still kept is newer than the next one to read: what lay between was purged.

    kept: each source's changes; state: its last position read.  Without a last position nothing was missed.
    """
    oldest = kept.groupBy(source).agg(F.min(position).alias("oldest_kept"))
    d = state.select(source, F.col(last).alias("last_read")).join(oldest, source)
    return d.filter(F.col("oldest_kept") > F.col("last_read"))


def never_captured(state: DataFrame, changes: DataFrame, source: str) -> DataFrame:
    """Sources of the state of which no change was ever captured."""
    return state.join(changes.select(source).distinct(), source, "left_anti")


def logged(spark: SparkSession, step: str, path: str, df: DataFrame, write: Callable[[DataFrame], None]) -> None:
    """Write df and append step, rows, times, status and error to the run log; rows are counted while they are written."""
    began, seen, error = datetime.datetime.now(datetime.UTC), Observation(), None
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    except Exception as x:
        error = str(x)[:3900]
        raise
    finally:
        rows = None if error else seen.get["rows"]
        ended = datetime.datetime.now(datetime.UTC)
        schema = "step string, rows bigint, started_at timestamp, ended_at timestamp, status string, error string"
        spark.createDataFrame([(step, rows, began, ended, "failed" if error else "success", error)], schema).write.mode("append").parquet(path)


def audit_index(documents: DataFrame, payload: str, schema: str, key: str, at: str) -> DataFrame:
    """Documents with a payload, parsed, one per key (the last), with the day they belong to; others are dropped."""
    d = documents.filter(F.col(payload).isNotNull()).withColumn("__sl_p", F.from_json(payload, schema))
    d = d.select(*(c for c in documents.columns if c != payload), "__sl_p.*")
    rest = [c for c in d.columns if c not in (key, at)]
    return standing(d, [key], [*rest, at], at).withColumn("event_date", F.to_date(at))


def flow_peer(source_port: Column, target_port: Column, peers: dict[int, str]) -> Column:
    """The name of the known port at either end of a flow; null without one."""
    out = F.lit(None).cast("string")
    for port, name in peers.items():
        out = F.when((source_port == port) | (target_port == port), F.lit(name)).otherwise(out)
    return out


def seed(tables: dict[str, tuple[DataFrame, list[str]]], root: str, force: bool = False) -> None:
    """Copy the standing rows of tables into a second warehouse; refuses to touch one that has rows, unless forced.

    tables: name -> (rows, key columns); tables without _version are copied as they are.
    """
    for name, (df, keys) in tables.items():
        path = f"{root}/{name}"
        if not force:
            try:
                if df.sparkSession.read.parquet(path).limit(1).count():
                    raise FileExistsError(path)
            except FileExistsError:
                raise
            except Exception:  # no such table yet
                pass
        rows = df
        if "_version" in df.columns:
            values = [c for c in df.columns if c not in [*keys, "_version"]]
            rows = standing(df, keys, [*values, "_version"]).select(*df.columns)
        rows.write.mode("overwrite").parquet(path)


#: What must be loaded before each table.
DEPENDS = {
    "dim_geography": set(), "dim_date": set(), "dim_shippers": set(), "dim_territories": set(), "dim_suppliers": {"dim_geography"}, "dim_customer": {"dim_geography"}, "dim_employees": {"dim_geography"},
    "dim_products": {"dim_suppliers"}, "fact_employee_territories": {"dim_employees", "dim_territories"}, "fact_orders": {"dim_products", "dim_customer", "dim_employees", "dim_shippers", "dim_geography", "dim_date"},
}


def run_all(spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]], root: str, log: str, depends: dict[str, set[str]] = DEPENDS) -> list[str]:
    """Run the loaders there are in load order, each written below root and noted in the run log; a failure ends the run."""
    done = []
    for name in load_order(depends):
        if name in loaders:
            logged(spark, name, log, loaders[name](), lambda d, n=name: d.write.mode("overwrite").parquet(f"{root}/{n}"))
            done.append(name)
    return done


def seed_reference(rows: DataFrame) -> DataFrame:
    """The first load of a reference table: every row with version 1, so that any later change stands."""
    return rows.withColumn("_version", F.lit(1).cast("bigint"))


def clone_empty(spark: SparkSession, source: str, target: str) -> None:
    """A table like another one, without its rows."""
    spark.createDataFrame([], spark.read.parquet(source).schema).write.mode("errorifexists").parquet(target)


def load_order(depends: dict[str, set[str]] = DEPENDS) -> list[str]:
    """Tables in an order in which each comes after what it needs."""
    return list(TopologicalSorter(depends).static_order())
