"""Applying a feed of inserts, updates and deletes: merge-on-read with equality deletes.

The feed is never merged into place.  It is appended to three tables: data rows (what inserts and
updates hold), deletes by line and deletes by order, each with the position of its change.  An
update or insert also appends a delete of its own line, which takes away whatever came before it.
Readers drop the data rows for which a later delete of the line or its order exists.  As positions
alone decide, repeated and out-of-order delivery, and the order of appends, change nothing.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.text import hex_position
from starloom.operators.skew import anti_join, hot_values, look_up
from starloom.sources.tables import Scratch, bounded

DELETE, INSERT, BEFORE, UPDATE = 1, 2, 3, 4  # operation codes of the feed (fixed values)
STATE_ROWS = 10_000  #: sources whose state is broadcast; beyond it the join is shuffled
HEADER = ["freight", "ship_name", "order_date"]
LINE = ["unit_price", "quantity", "discount"]


def counting_changes(feed: DataFrame, state: DataFrame) -> DataFrame:
    """The changes up to each source's last position, without before-images.

    A source without a position, or not in state, was never read, so none of its changes count;
    of a source listed twice the greater position counts.  A change without start_lsn has no place
    in the order and doesn't count; without seqval it is the first of its transaction.
    """
    own = ["operation", "order_id", "product_id", *LINE, *HEADER]
    zero = F.lit("0" * 20)
    c = feed.select(
        F.rtrim("capture_instance").alias("capture_instance"),
        F.struct(hex_position(F.col("start_lsn")).alias("start_lsn"), F.coalesce(hex_position(F.col("seqval")), zero).alias("seqval")).alias("pos"),
        *own,
    ).filter(F.col("operation").isin(DELETE, INSERT, UPDATE))
    s = state.groupBy(F.rtrim("capture_instance").alias("capture_instance")).agg(F.max(hex_position(F.col("last_lsn"))).alias("__sl_last"))
    s = F.broadcast(s) if bounded(s, STATE_ROWS) else s
    return c.join(s, "capture_instance").filter(F.col("pos.start_lsn") <= F.col("__sl_last")).drop("__sl_last")


class EqualityDeleteTable:
    """The three append-only tables, as one folder partitioned by kind."""

    KINDS = ("data", "header", "line_delete", "order_delete")

    def __init__(self, spark: SparkSession, path: str, line_source: str = "dbo_OrderDetails", order_source: str = "dbo_Orders") -> None:
        self.spark, self.path = spark, path
        self.line_source, self.order_source = line_source, order_source

    def append(self, changes: DataFrame) -> None:
        """Append counting changes.  Changes without the keys of their kind name no line and are left out."""
        line = (F.col("capture_instance") == self.line_source) & F.col("order_id").isNotNull() & F.col("product_id").isNotNull()
        order = (F.col("capture_instance") == self.order_source) & F.col("order_id").isNotNull()
        gone = F.col("operation") == DELETE
        kinds = [F.when(line & ~gone, F.lit("data")), F.when(line, F.lit("line_delete")), F.when(order & ~gone, F.lit("header")), F.when(order & gone, F.lit("order_delete"))]
        rows = changes.select(F.explode(F.array_compact(F.array(*kinds))).alias("kind"), "order_id", "product_id", "pos", *LINE, *HEADER)
        rows.write.mode("append").partitionBy("kind").option("compression", "zstd").parquet(self.path)
        self.schema = rows.schema
        self.__dict__.pop("hot_orders", None)

    def rows(self, kind: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).filter(F.col("kind") == kind)

    def deletes(self) -> tuple[DataFrame, DataFrame]:
        """Each key's last delete; an earlier one takes nothing away that the last one leaves."""
        line = self.rows("line_delete").groupBy("order_id", "product_id").agg(F.max("pos").alias("del_pos"))
        order = self.rows("order_delete").groupBy("order_id").agg(F.max("pos").alias("order_pos"))
        return line, order

    @cached_property
    def hot_orders(self) -> list:
        """Orders that have a large share of all line changes, when order deletes are too many to broadcast."""
        return hot_values(self.rows("line_delete"), "order_id")

    def live(self) -> DataFrame:
        """order_id, product_id, pos and values of the lines that are there."""
        line, order = self.deletes()
        line = line.select(F.col("order_id").alias("__sl_o"), F.col("product_id").alias("__sl_p"), "del_pos")
        # copies of one change are combined before the shuffle
        data = self.rows("data").groupBy("order_id", "product_id", "pos").agg(F.max(F.struct(*LINE)).alias("values"))
        rows = data.join(line, (F.col("order_id") == F.col("__sl_o")) & (F.col("product_id") == F.col("__sl_p")) & (F.col("pos") < F.col("del_pos")), "left_anti")
        rows = anti_join(rows, order, "order_id", F.col("product_id"), F.col("pos") < F.col("order_pos"), lambda: self.hot_orders)
        return rows.select("order_id", "product_id", "pos", *(F.col(f"values.{c}").alias(c) for c in LINE))

    def lines(self) -> DataFrame:
        """order_id, product_id, pos, is_deleted, values: every line ever changed and the change that decides it.

        A line that isn't there is decided by the later of its own last change and the last delete
        of its order.  A line's own delete and insert at one position leave the line there.
        """
        line, order = self.deletes()
        there = self.live().withColumn("is_deleted", F.lit(0))
        gone = line.join(there.select("order_id", "product_id"), ["order_id", "product_id"], "left_anti")
        gone = look_up(gone, order, "order_id", F.col("product_id"), hot=lambda: self.hot_orders)
        gone = gone.select(
            "order_id", "product_id",
            F.when(F.col("order_pos") > F.col("del_pos"), F.col("order_pos")).otherwise(F.col("del_pos")).alias("pos"),
            F.lit(1).alias("is_deleted"),
        )
        return there.unionByName(gone, allowMissingColumns=True)

    def headers(self) -> DataFrame:
        """The last known header of each order."""
        return self.rows("header").groupBy("order_id").agg(F.max(F.struct("pos", *HEADER)).alias("__sl_h")).select("order_id", *(F.col(f"__sl_h.{c}").alias(c) for c in HEADER))


def apply_feed(spark: SparkSession, feed: DataFrame, state: DataFrame, batches: int = 1) -> EqualityDeleteTable:
    """The feed's counting changes appended to a new table in the shared folder; several batches only test that appends commute."""
    table = EqualityDeleteTable(spark, Scratch(spark).path())
    changes = counting_changes(feed, state)
    for i in range(batches):
        part = changes if batches == 1 else changes.filter(F.pmod(F.xxhash64("pos", "order_id"), F.lit(batches)) == i)
        table.append(part)
    return table


def net_changes(changes: DataFrame, keys: list[str], position: list[str], values: list[str]) -> DataFrame:
    """The last change of each key; combined before the shuffle, so copies of one key cost nothing."""
    best = F.max(F.struct(*position, *values)).alias("__sl_b")
    return changes.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__sl_b.{c}").alias(c) for c in [*position, *values]))


def whole_transactions(changes: DataFrame, lsn: str, last: str | int | None, most_rows: int, bucket: Column) -> DataFrame:
    """The next transactions after ``last``: as many as have ``most_rows`` rows together, and always at least one.

    A transaction is never cut.  Rows are counted per position first, so the window sees
    positions, not rows; bucket is a function of the position that must not fall as it rises.
    """
    c = changes if last is None else changes.filter(F.col(lsn) > F.lit(last))
    sizes = c.groupBy(lsn).count()
    from starloom.operators.ordering import running_sum

    upto = running_sum(sizes, [], [lsn], "count", "__sl_sum", bucket)
    upto = upto.filter((F.col("__sl_sum") <= most_rows) | (F.col("__sl_sum") == F.col("count"))).select(lsn)
    return c.join(upto, lsn, "left_semi")


def split_by_operation(changes: DataFrame, op: Column) -> DataFrame:
    names = {DELETE: "delete", INSERT: "insert", UPDATE: "update"}
    return changes.withColumn("operation_name", reduce(lambda a, kv: F.when(op == kv[0], kv[1]).otherwise(a), names.items(), F.lit("other")))
