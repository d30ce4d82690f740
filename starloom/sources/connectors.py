"""Readers and writers around the warehouse: JDBC, files, message envelopes, state tables."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.values import fill_zeros
from starloom.sources.tables import bounded


@dataclass(frozen=True)
class Config:
    """Settings from the environment; file-based unless a JDBC address is given."""

    warehouse: str = "warehouse"
    staging: str = "staging"
    jdbc_url: str = ""
    jdbc_user: str = ""
    jdbc_password: str = ""
    kafka: str = ""
    rows_per_pass: int = 5000
    poll_seconds: int = 5

    @classmethod
    def of_environment(cls, prefix: str = "STARLOOM_") -> Config:
        return cls(**{f: type(getattr(cls, f))(os.environ[prefix + f.upper()]) for f in cls.__dataclass_fields__ if prefix + f.upper() in os.environ})


@dataclass(frozen=True)
class Source:
    """A captured table: its topic, the warehouse table it feeds, its key columns and whether deletes are passed on."""

    capture_instance: str
    target_table: str
    business_key: tuple[str, ...]
    propagate_deletes: bool = False

    @property
    def topic(self) -> str:
        return "rt." + "".join(f"_{c.lower()}" if c.isupper() else c for c in self.capture_instance.removeprefix("dbo_")).lstrip("_")


SOURCES = (
    Source("dbo_Orders", "fact_orders", ("order_id",), True),
    Source("dbo_OrderDetails", "fact_orders", ("order_id", "product_id"), True),
    Source("dbo_EmployeeTerritories", "fact_employee_territories", ("employee_id", "territory_id"), True),
    Source("dbo_Customers", "dim_customer", ("customer_id",)),
    Source("dbo_Products", "dim_products", ("product_id",)),
    Source("dbo_Employees", "dim_employees", ("employee_id",)),
    Source("dbo_Suppliers", "dim_suppliers", ("supplier_id",)),
    Source("dbo_Shippers", "dim_shippers", ("shipper_id",)),
    Source("dbo_Territories", "dim_territories", ("territory_id",)),
    Source("dbo_Categories", "ref_categories", ("category_id",)),
    Source("dbo_Region", "ref_region", ("region_id",)),
)


def read_jdbc(spark: SparkSession, config: Config, query: str, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A query run by the source database; with (column, low, high, n) read by n tasks at once."""
    r = spark.read.format("jdbc").option("url", config.jdbc_url).option("user", config.jdbc_user).option("password", config.jdbc_password)
    if partition is None:
        return r.option("query", query).load()
    column, low, high, n = partition
    return r.option("dbtable", f"({query}) q").options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=n).load()


def write_jdbc(df: DataFrame, config: Config, table: str, mode: str = "append", batch: int = 5000) -> None:
    df.write.format("jdbc").option("url", config.jdbc_url).option("user", config.jdbc_user).option("password", config.jdbc_password).option("dbtable", table).option("batchsize", batch).option("truncate", "true").mode(mode).save()


def write_table(df: DataFrame, path: str, schema: T.StructType, nullable: tuple[str, ...] = (), mode: str = "append", partition_by: tuple[str, ...] = (), sort: tuple[str, ...] = ()) -> None:
    """Append rows in a table's column order and types, nulls replaced; executors write, nothing is collected."""
    out = fill_zeros(df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields)), nullable)
    if sort:
        out = out.sortWithinPartitions(*sort)
    w = out.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def read_kafka(spark: SparkSession, config: Config, topics: list[str]) -> DataFrame:
    """A stream of messages; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", config.kafka).option("subscribe", ",".join(topics)).option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", config.rows_per_pass).load()


def storage(table: DataFrame, name: str) -> DataFrame:
    """table_name, rows, files and bytes of a file-based table."""
    m = table.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b")).groupBy("p", "b").count()
    return m.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("rows"), F.count("p").alias("files"), F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("bytes")).select(F.lit(name).alias("table_name"), "rows", "files", "bytes")


# Message envelopes

ENVELOPE = "capture_instance string, source_table string, target_table string, operation string, business_key string, lsn string, seqval string, source_time string, data map<string,string>"


def business_key(columns: list[str]) -> Column:
    """Key columns joined by |; a null is the empty text."""
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def encode(df: DataFrame, source: Source, lsn: str, seqval: str, operation: str, at: str, data: list[str]) -> DataFrame:
    """key and value of a message per change: a JSON envelope whose data are texts."""
    one = F.create_map(*(x for c in data for x in (F.lit(c), F.col(c).cast("string"))))
    envelope = F.struct(
        F.lit(source.capture_instance).alias("capture_instance"), F.lit(source.capture_instance.replace("_", ".", 1)).alias("source_table"), F.lit(source.target_table).alias("target_table"),
        F.col(operation).cast("string").alias("operation"), business_key(list(source.business_key)).alias("business_key"), F.col(lsn).cast("string").alias("lsn"), F.col(seqval).cast("string").alias("seqval"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("source_time"), one.alias("data"),
    )
    return df.select(business_key(list(source.business_key)).alias("key"), F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns of each message; rows that are no envelope have a null capture_instance (dead letters)."""
    return messages.withColumn("__sl_e", F.from_json(F.col(value).cast("string"), ENVELOPE, {"mode": "PERMISSIVE"})).select(*(c for c in messages.columns if c != value), F.col(value).cast("string").alias("raw"), "__sl_e.*")


# State

def read_state(spark: SparkSession, path: str, schema: str, key: str, version: str = "updated_at") -> DataFrame:
    """The last written row of each key of an append-only state table."""
    from starloom.operators.standing import standing

    s = spark.read.schema(schema).parquet(path)
    return standing(s, [key], [c for c in s.columns if c not in (key, version)] + [version], version)


def upsert_config(state: DataFrame, config: DataFrame, key: str, config_columns: list[str]) -> DataFrame:
    """State with configuration taken over and run-time columns kept; keys of the configuration alone get nulls there."""
    c = config.select(F.col(key).alias("__sl_k"), *(F.col(x).alias(f"__sl_{x}") for x in config_columns))
    d = state.join(c, F.col(key) == F.col("__sl_k"), "full_outer")
    known = F.col("__sl_k").isNotNull()
    return d.select(F.coalesce(key, "__sl_k").alias(key), *(F.when(known, F.col(f"__sl_{x}")).otherwise(F.col(x)).alias(x) if x in config_columns else F.col(x) for x in state.columns if x != key))


def in_key_order(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Changes of a key together and in order, as a partitioned topic would deliver them."""
    return changes.repartition(key).sortWithinPartitions(key, *order)


def write_kafka(messages: DataFrame, config: Config, topic: str, order: list[str]) -> None:
    """Messages (key, value) to a topic; those of a key are sent one after the other in ``order`` and have one partition."""
    in_key_order(messages, "key", order).select("key", "value", F.lit(topic).alias("topic")).write.format("kafka").option("kafka.bootstrap.servers", config.kafka).save()


def publishable(changes: DataFrame, state: DataFrame, source: str, operation: str, delete: int = 1) -> DataFrame:
    """Changes of active sources; deletes only of those that pass them on."""
    s = state.groupBy(source).agg(F.max("propagate_deletes").alias("__sl_deletes"), F.max("is_active").alias("__sl_active"))
    d = changes.join(F.broadcast(s) if bounded(s, 10_000) else s, source)
    return d.filter(F.col("__sl_active") & ((F.col(operation) != delete) | F.col("__sl_deletes"))).select(*changes.columns)
