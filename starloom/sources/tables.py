"""Reading the test tables and writing intermediate ones."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table.  Its timestamps carry no zone and mean UTC, so the session is set to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Unset, a temporary folder is used with a local master; on a cluster that would not be
    shared, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="starloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class Scratch:
    """Tables written to the shared folder to cut lineage: a lost executor loses none of them.

    A written table is computed once, where an eager checkpoint() runs its last stage twice.
    ``close`` removes what is left; it also runs when Python ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/starloom-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(self.close)

    def path(self) -> str:
        self._n += 1
        return f"{self.root}/{self._n}"

    def put(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        path = self.path()
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._starloom_path = path
        return out

    def drop(self, table: DataFrame) -> None:
        if path := getattr(table, "_starloom_path", None):
            remove(self.spark, path)

    def close(self) -> None:
        atexit.unregister(self.close)
        try:
            remove(self.spark, self.root)
        except Exception:  # the session has ended, and its folder is the cluster's to clear
            pass


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores: one small file would else keep a single Python worker busy."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no more of it than needed to tell."""
    return len(df.select(*df.columns[:1]).limit(rows + 1).toArrow()) <= rows
