"""Catalogue of files or blobs by size and checksum, and its verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, content of the files below a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def catalogue(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """key, size_bytes, checksum_sha256 of whole contents; null content has size 0 and no checksum."""
    c = F.col(content).cast("binary")
    return files.select(key, F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint").alias("size_bytes"), F.sha2(c, 256).alias("checksum_sha256"))


def verify(known: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Catalogued entries that are missing or were modified."""
    a = actual.select(F.col(key).alias("__sl_k"), F.struct("size_bytes", "checksum_sha256").alias("__sl_is"))
    d = known.join(a, F.col(key) == F.col("__sl_k"), "left")
    status = F.when(F.col("__sl_is").isNull(), "missing").when(~F.struct("size_bytes", "checksum_sha256").eqNullSafe(F.col("__sl_is")), "modified")
    return d.select(key, status.alias("status")).filter(F.col("status").isNotNull())
