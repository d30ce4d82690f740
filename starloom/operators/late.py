"""Per-period aggregates that late events correct, with a cut-off.

A store keeps mergeable partial aggregates per key, period and arrival batch.  A load appends what it
adds; readers sum the partials, or compact them first.  A partial is a handful of numbers, so what
readers touch grows with periods and batches, not events.  Events that come after a period is closed
are refused: counted, but in no total.

Loads may overlap and come in any order: the store also remembers each record by its place in its topic.
A copy of a known record adds nothing; if the copy turns out to be the earlier delivery, the partial of
the other is taken back.  A load that is repeated under its name replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.text import epoch_micros, epoch_seconds

HOUR = 3600
ALLOWED_LATENESS = 2 * HOUR
KEYS = ["capture_instance", "period_start", "arrived_in", "status"]
SUMS = ["events", "rows_written", "errors"]
PLACE = ["topic", "kafka_partition", "kafka_offset"]
BLOCK = 1 << 20  #: offsets in a folder of known records
BLOCKS = 1_000  #: folders that a load may name to prune what it reads
_PARTIAL = "capture_instance string, period_start bigint, arrived_in bigint, status string, events bigint, rows_written bigint, errors bigint"


def _named() -> Column:
    """Whether a record has a place, so that copies of it can be told."""
    return F.col("topic").isNotNull() & F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull()


def _rank() -> Column:
    """Order of a record's deliveries; the least is the event.

    First by event_time, a null last; of equal ones, one that tells its time of happening goes first.
    """
    timed = F.col("source_time").isNotNull() | F.col("lag_ms").isNotNull()
    own = ["capture_instance", "source_time", "lag_ms", "rows_written", "failed"]
    return F.struct(F.col("event_time").isNull().alias("untimed"), "event_time", (~timed).alias("unknown"), *own)


def records(events: DataFrame) -> DataFrame:
    """What counts of each event: its place, its own values and whether it failed."""
    return events.select(
        F.rtrim("capture_instance").alias("capture_instance"), "event_time", "source_time", "lag_ms", F.col("rows_written").cast("bigint").alias("rows_written"),
        F.coalesce(F.length(F.rtrim("error")) > 0, F.lit(False)).alias("failed"),
        F.rtrim("topic").alias("topic"), F.col("kafka_partition").cast("int").alias("kafka_partition"), F.col("kafka_offset").cast("bigint").alias("kafka_offset"),
    )


def first_deliveries(events: DataFrame) -> DataFrame:
    """One record of those with equal topic, kafka_partition and kafka_offset: the first by event_time (see _rank).

    Records without one of the three can't be told to be copies and all stay.
    """
    e = records(events)
    best = e.filter(_named()).groupBy(*PLACE).agg(F.min(_rank()).alias("r"))
    own = [c for c in e.columns if c not in PLACE]
    return best.select(*(F.col(f"r.{c}").alias(c) for c in own), *PLACE).unionByName(e.filter(~_named()))


def partials(events: DataFrame, period: int = HOUR, lateness: int = ALLOWED_LATENESS, sign: Column | None = None) -> DataFrame:
    """Partial aggregates of first deliveries: KEYS, SUMS; sign -1 takes an event back.

    An event happened at source_time or else lag_ms before event_time; it is left out without
    both, and without event_time, as it then arrived in no batch.  period_start and arrived_in
    are epoch seconds.  status is 'on_time', 'late' or 'refused'.  Null rows_written counts as 0.
    """
    sign = F.lit(1) if sign is None else sign
    happened = F.coalesce(epoch_micros(F.col("source_time")), epoch_micros(F.col("event_time")) - F.col("lag_ms") * 1000)
    e = events.withColumn("__sl_happened", happened).filter(F.col("__sl_happened").isNotNull() & F.col("event_time").isNotNull())
    start = F.floor(F.col("__sl_happened") / F.lit(period * 1_000_000)).cast("bigint") * period
    e = e.withColumn("period_start", start)
    end = (F.col("period_start") + period) * 1_000_000
    arrived = epoch_micros(F.col("event_time"))
    e = e.withColumn("arrived_in", (F.floor(epoch_seconds(F.col("event_time")) / F.lit(period)) * period).cast("bigint"))
    e = e.withColumn("status", F.when(arrived < end, "on_time").when(arrived <= end + lateness * 1_000_000, "late").otherwise("refused"))
    return e.groupBy(*KEYS).agg(
        F.sum(sign).cast("bigint").alias("events"),
        F.sum(sign * F.coalesce(F.col("rows_written"), F.lit(0))).cast("bigint").alias("rows_written"),
        F.sum(sign * F.col("failed").cast("bigint")).cast("bigint").alias("errors"),
    )


def merge(*stores: DataFrame) -> DataFrame:
    """Partials of all; what was taken back whole is gone."""
    every = stores[0]
    for s in stores[1:]:
        every = every.unionByName(s)
    return every.groupBy(*KEYS).agg(*(F.sum(c).cast("bigint").alias(c) for c in SUMS)).filter(F.col("events") != 0)


class PartialStore:
    """Partials and known records below a folder that all executors share, a sub-folder for each load."""

    def __init__(self, spark: SparkSession, path: str, period: int = HOUR, lateness: int = ALLOWED_LATENESS) -> None:
        self.spark, self.path, self.period, self.lateness = spark, path, period, lateness
        self.loads: list[str] = []

    def _known(self, name: str, schema: str, touched: DataFrame) -> DataFrame | None:
        """The best delivery known of each record in the blocks of offsets that a load touches, but for what the load itself wrote."""
        others = [n for n in self.loads if n != name]
        if not others:
            return None
        blocks = [r[0] for r in touched.select("offset_block").distinct().limit(BLOCKS + 1).collect()]
        known = self.spark.read.schema(schema).option("basePath", f"{self.path}/known").parquet(*(f"{self.path}/known/load={n}" for n in others))
        return known.filter(F.col("offset_block").isin(blocks)) if len(blocks) <= BLOCKS else known

    def load(self, events: DataFrame, name: str) -> None:
        """Append what a batch of events adds, under the load's name.

        Records without a place can't be told from one another: each load's count, so a load must not
        hold those of another.
        """
        from starloom.sources.tables import Scratch

        scratch = Scratch(self.spark)
        block = F.floor(F.col("kafka_offset") / BLOCK).cast("bigint").alias("offset_block")
        new = scratch.put(first_deliveries(events).select("*", block))
        named = new.filter(_named()).select("offset_block", *PLACE, _rank().alias("r"))
        schema = f"topic string, kafka_partition int, kafka_offset bigint, r {named.schema['r'].dataType.simpleString()}, load string, offset_block bigint"
        known = self._known(name, schema, named)
        if known is None:
            changed = named.withColumn("had", F.lit(None).cast(named.schema["r"].dataType))
        else:
            both = named.withColumn("mine", F.lit(True)).unionByName(known.select(*named.columns, F.lit(False).alias("mine")))
            both = both.groupBy("offset_block", *PLACE).agg(F.max("mine").alias("mine"), F.min("r").alias("r"), F.min(F.when(~F.col("mine"), F.col("r"))).alias("had"))
            changed = both.filter(F.col("mine") & (F.col("had").isNull() | (F.col("r") < F.col("had")))).drop("mine")
            changed = scratch.put(changed)
        changed.select(*PLACE, "r", "offset_block").write.mode("overwrite").partitionBy("offset_block").option("compression", "zstd").parquet(f"{self.path}/known/load={name}")
        added = changed.select("r.*", F.lit(1).alias("sign")).unionByName(changed.filter(F.col("had").isNotNull()).select("had.*", F.lit(-1).alias("sign")))
        nameless = new.filter(~_named()).select(*(c for c in added.columns if c not in ("untimed", "unknown", "sign")), F.lit(1).alias("sign"))
        delta = partials(added.drop("untimed", "unknown").unionByName(nameless), self.period, self.lateness, F.col("sign"))
        delta.write.mode("overwrite").parquet(f"{self.path}/partials/load={name}")
        scratch.close()
        self.loads = [*(n for n in self.loads if n != name), name]

    def partials(self) -> DataFrame:
        """The partials of all loads, merged."""
        if not self.loads:
            return self.spark.createDataFrame([], _PARTIAL)
        return merge(self.spark.read.schema(_PARTIAL).parquet(*(f"{self.path}/partials/load={n}" for n in self.loads)))

    def compact(self) -> None:
        """Put all loads' partials together as one, so that readers merge fewer of them.  Loads can't be repeated afterwards."""
        from starloom.sources.tables import remove

        old = list(self.loads)
        name = f"upto-{old[-1]}"
        self.partials().write.mode("overwrite").parquet(f"{self.path}/partials/load={name}")
        known = self.spark.read.option("basePath", f"{self.path}/known").parquet(*(f"{self.path}/known/load={n}" for n in old))
        best = known.groupBy("offset_block", *PLACE).agg(F.min("r").alias("r"))
        best.write.mode("overwrite").partitionBy("offset_block").option("compression", "zstd").parquet(f"{self.path}/known/load={name}")
        self.loads = [name]
        for n in old:
            remove(self.spark, f"{self.path}/partials/load={n}")
            remove(self.spark, f"{self.path}/known/load={n}")


def revisions(store: DataFrame) -> DataFrame:
    """Each period's totals after each batch that changed them.

    revision 0 is what stood when the period ended; one revision follows for each arrival hour
    with late events.  The window runs over partials: one row for each arrival hour of a period.
    """
    kept = store.filter(F.col("status") != "refused")
    batch = F.when(F.col("status") == "late", F.col("arrived_in"))
    per = kept.groupBy("capture_instance", "period_start", batch.alias("revised_in")).agg(*(F.sum(c).cast("bigint").alias(c) for c in SUMS))
    whole = Window.partitionBy("capture_instance", "period_start")
    w = whole.orderBy(F.col("revised_in").asc_nulls_first())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    on_time = F.max(F.col("revised_in").isNull().cast("int")).over(whole)  # else its first revision is number 1
    return per.select(
        "capture_instance", "period_start", "revised_in",
        (F.row_number().over(w) - on_time).cast("bigint").alias("revision"),
        *(F.col(c).alias(f"added_{c}") for c in SUMS),
        *(F.sum(c).over(upto).cast("bigint").alias(c) for c in SUMS),
    )


def totals(store: DataFrame) -> DataFrame:
    """Each period's final totals, and what was refused."""
    kept = F.col("status") != "refused"
    return store.groupBy("capture_instance", "period_start").agg(
        *(F.coalesce(F.sum(F.when(kept, F.col(c))), F.lit(0)).cast("bigint").alias(c) for c in SUMS),
        F.coalesce(F.sum(F.when(F.col("status") == "late", F.col("events"))), F.lit(0)).cast("bigint").alias("late_events"),
        F.coalesce(F.sum(F.when(~kept, F.col("events"))), F.lit(0)).cast("bigint").alias("refused_events"),
    )
