"""Dimensions, inferred members, bridges and telemetry kept by streams.

A dimension table is an append-only folder: a row for each version, later rows of a surrogate key
replacing earlier ones.  Each version remembers the position of the last change it holds, so a
micro-batch that is replayed, or a change that is delivered again, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.contract import Dimension
from starloom.operators import keys
from starloom.operators.scd import NEW, SAME, STUB, TYPE1, TYPE2
from starloom.operators.standing import open_end, standing
from starloom.functions.values import any_differs
from starloom.sources.tables import Scratch


class DimensionTable:
    """A dimension's rows below a folder that all executors share; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, dimension: Dimension, alternate_type: str = "bigint") -> None:
        self.spark, self.path, self.dimension = spark, path, dimension
        attributes = [f"{f.name} {f.dataType.simpleString()}" for f in dimension.schema]
        own = [f"{dimension.surrogate} bigint", f"{dimension.alternate} {alternate_type}", *attributes, "start_date timestamp_ntz", "end_date timestamp_ntz", "is_inferred int", "position string", "_version bigint"]
        self.schema = T.StructType.fromDDL(", ".join(own))
        self._append(spark.createDataFrame([], self.schema))

    def _append(self, rows: DataFrame) -> None:
        rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema)).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """The standing row of each version."""
        d = self.spark.read.schema(self.schema).parquet(self.path)
        key = self.dimension.surrogate
        return standing(d, [key], [c for c in d.columns if c not in (key, "_version")] + ["_version"]).select(*d.columns)

    def open_rows(self) -> DataFrame:
        return self.rows().filter(F.col("end_date") == open_end())

    def ensure(self, wanted: DataFrame, at: Column, version: Column) -> None:
        """Inferred members for the alternate keys (column of that name) that the table lacks."""
        d = self.dimension
        missing = keys.missing_keys(wanted, self.rows(), d.alternate, d.alternate)
        stubs = keys.stubs(d, missing, keys.highest_key(self.rows(), d.surrogate), at, version)
        if not d.has_history:
            stubs = stubs.withColumns({"start_date": at, "end_date": open_end()})
        self._append(Scratch(self.spark).put(stubs.withColumn("position", F.lit(""))))

    def apply(self, changes: DataFrame, version: Column) -> DataFrame:
        """Append what changes make of the table, and return each key's outcomes: alternate key, scd_outcome, changes.

        changes: the alternate key, the attributes, at and position (texts that order a key's changes).
        Several changes of a key are applied one after the other.  A versioned attribute that differs
        closes a version and opens the next at the change's time; others are overwritten.  An inferred
        member is filled in place.  Changes not after what a key's open version holds are left out, as
        are those without a key.
        """
        d, scratch = self.dimension, Scratch(self.spark)
        alt, values = d.alternate, d.schema.names
        c = changes.filter(F.col(alt).isNotNull()).groupBy(alt, "position").agg(F.max(F.struct("at", *values)).alias("v")).select(alt, "position", "v.*")
        now = scratch.put(self.open_rows().join(c.select(alt).distinct(), alt, "left_semi"))
        c = c.join(now.select(alt, F.col("position").alias("__sl_had")), alt, "left").filter(F.col("__sl_had").isNull() | (F.col("position") > F.col("__sl_had"))).drop("__sl_had")
        base = now.select(alt, "position", F.col("start_date").alias("at"), *values, F.col(d.surrogate).alias("key"), F.col("is_inferred").alias("stub"))
        both = base.withColumn("step", F.lit(0)).unionByName(c.withColumns({"key": F.lit(None).cast("bigint"), "stub": F.lit(0), "step": F.lit(1)}))
        w = Window.partitionBy(alt).orderBy("step", "position")
        before = lambda x: F.lag(x).over(w)
        two = any_differs([(F.col(x), before(x)) for x in d.type2])
        one = any_differs([(F.col(x), before(x)) for x in d.type1])
        first = F.row_number().over(w) == 1
        outcome = F.when(F.col("step") == 0, F.lit(None)).when(first, NEW).when(before("stub") == 1, STUB).when(two, TYPE2).when(one, TYPE1).otherwise(SAME)
        both = scratch.put(both.withColumn("outcome", outcome).withColumn("version_no", F.sum(F.when(first | (F.col("outcome") == TYPE2), 1).otherwise(0)).over(w)))
        order = F.struct("step", "position")
        v = both.groupBy(alt, "version_no").agg(
            F.max("key").alias("key"), F.min_by("at", order).alias("start_date"), F.max("position").alias("position"),
            *(F.max_by(x, order).alias(x) for x in values), F.count_if(F.col("outcome").isin(NEW, STUB, TYPE1, TYPE2)).alias("n"),
        )
        nxt = F.lead("start_date").over(Window.partitionBy(alt).orderBy("version_no"))
        v = v.withColumns({"end_date": F.coalesce(nxt, open_end()), "is_inferred": F.lit(0), "_version": version.cast("bigint")}).filter((F.col("n") > 0) | (F.col("end_date") != open_end()))
        v = scratch.put(v.withColumn("__sl_own", F.concat_ws("|", F.col(alt).cast("string"), F.col("version_no").cast("string"))))
        opened = keys.assign_keys(v.filter(F.col("key").isNull()).drop("key"), "__sl_own", "key", keys.highest_key(self.rows(), d.surrogate))
        written = v.filter(F.col("key").isNotNull()).unionByName(opened.select(*v.columns))
        self._append(scratch.put(written.withColumnRenamed("key", d.surrogate)))
        return both.filter(F.col("outcome").isNotNull()).groupBy(alt, F.col("outcome").alias("scd_outcome")).agg(F.count(F.lit(1)).alias("changes"))

    def relink(self, parent: str, reports_to: str, version: Column) -> None:
        """Give open rows the surrogate key of their parent's open row, where it has changed or came later."""
        d = self.dimension
        now = self.open_rows()
        linked = keys.hierarchy_keys(now, d.surrogate, d.alternate, reports_to, "__sl_parent")
        changed = linked.filter(~F.col("__sl_parent").eqNullSafe(F.coalesce(F.col(parent), F.lit(0))))
        self._append(Scratch(self.spark).put(changed.withColumn(parent, F.col("__sl_parent")).withColumn("_version", version.cast("bigint"))))


class BridgeTable:
    """Pairs of two keys, append-only with tombstones: the last change of a pair decides."""

    def __init__(self, spark: SparkSession, path: str, left: str, right: str) -> None:
        self.spark, self.path, self.left, self.right = spark, path, left, right

    def append(self, changes: DataFrame) -> None:
        """changes: both keys, is_deleted, position.  Pairs without one of the keys are none."""
        d = changes.filter(F.col(self.left).isNotNull() & F.col(self.right).isNotNull())
        d.select(self.left, self.right, "is_deleted", "position").write.mode("append").parquet(self.path)

    def pairs(self) -> DataFrame:
        d = standing(self.spark.read.parquet(self.path), [self.left, self.right], ["is_deleted"], "position")
        return d.filter(F.col("is_deleted") == 0).select(self.left, self.right)


def stream_events(applied: DataFrame, at: Column, outcome: str = "scd_outcome", rows: str = "rows_written") -> DataFrame:
    """Telemetry rows of applied envelopes: when, how late, from where, what came of it."""
    lag = F.unix_millis(at.cast("timestamp")) - F.unix_millis(F.col("source_time").cast("timestamp"))
    topic = F.concat(F.lit("rt."), F.ltrim(F.lower(F.regexp_replace(F.regexp_replace("capture_instance", "^dbo_", ""), "([A-Z])", "_$1")), F.lit("_")))
    return applied.select(
        at.cast("timestamp_ntz").alias("event_time"), F.col("source_time").cast("timestamp_ntz").alias("source_time"), lag.alias("lag_ms"), "capture_instance", topic.alias("topic"), "target_table",
        F.element_at(F.create_map(*(F.lit(x) for x in ("1", "delete", "2", "insert", "3", "before", "4", "update"))), F.col("operation").cast("string")).alias("operation"),
        F.col(outcome).alias("scd_outcome"), "business_key", F.col(rows).cast("bigint").alias("rows_written"), F.coalesce(F.col("error"), F.lit("")).alias("error"),
    )


def audit_documents(events: DataFrame) -> DataFrame:
    """id and JSON body of an audit document per telemetry row; the id follows from the content, so a replayed batch overwrites its own."""
    body = F.to_json(F.struct(*events.columns))
    return events.select(F.sha2(body, 256).alias("id"), F.to_date("event_time").alias("event_date"), body.alias("body"))


def apply_dimension(messages: DataFrame, table: DimensionTable, rows_of: Callable[[DataFrame], DataFrame], checkpoint: str, after: Callable[[DataFrame, int], None] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Apply each micro-batch's changes (rows_of gives them from its messages) to a dimension; after gets outcomes and batch."""

    def batch(df: DataFrame, batch_id: int) -> None:
        said = table.apply(rows_of(df), F.lit(batch_id + 1))
        if after:
            after(said, batch_id)

    return messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


class Lease:
    """One writer per table: a file that only one can create.  Held as a context; a lease left by a lost writer is removed by hand."""

    def __init__(self, spark: SparkSession, table_path: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}.lease")
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def __enter__(self) -> Lease:
        if not self.fs.createNewFile(self.path):
            raise RuntimeError(f"{self.path.toString()}: the table has a writer")
        return self

    def __exit__(self, *_) -> None:
        self.fs.delete(self.path, False)


def stop_after_batch(query: StreamingQuery) -> None:
    """End a stream when what has arrived is applied, so that no micro-batch is cut off."""
    query.processAllAvailable()
    query.stop()
