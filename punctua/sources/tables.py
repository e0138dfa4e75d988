"""Publishing tables and comparing rebuilds."""

from __future__ import annotations

import re
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["drop_namespace", "fingerprint", "publish", "read_published"]

_POINTER = "_current"


def publish(df: DataFrame, root: str, name: str, namespace: str = "main",
            partition_by: tuple[str, ...] = ()) -> str:
    """A9. Write a full new version beside the old one, then move the pointer to it.

    Readers keep the previous version until the write has fully succeeded, and a failed or repeated
    write leaves no half table behind. The pointer is a one-row table, written last.
    """
    version = f"{root.rstrip('/')}/{namespace}/{name}/v-{uuid4().hex}"
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version)
    pointer = df.sparkSession.range(1).select(F.lit(version).alias("path"), F.current_timestamp().alias("published_at"))
    pointer.write.mode("append").parquet(f"{root.rstrip('/')}/{namespace}/{name}/{_POINTER}")
    return version


def read_published(spark: SparkSession, root: str, name: str, namespace: str = "main") -> DataFrame:
    """A9. The newest published version of a table."""
    pointer = spark.read.parquet(f"{root.rstrip('/')}/{namespace}/{name}/{_POINTER}")
    return spark.read.parquet(pointer.agg(F.max_by("path", "published_at")).first()[0])


def drop_namespace(spark: SparkSession, root: str, namespace: str, droppable: str = "ci") -> bool:
    """A12. Remove a throwaway namespace; anything not named so is refused."""
    if namespace.lower() != droppable or not re.fullmatch(r"[a-z0-9_]+", namespace.lower()):
        return False
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{namespace}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def fingerprint(df: DataFrame, key: str, measures: Mapping[str, Column]) -> DataFrame:
    """A11. Row count, a hash of all keys and any totals, independent of row order.

    The hash of a key is the first 15 hexadecimal digits of the MD5 of its text, so another engine can compute the same fingerprint. XOR finds a
    changed or missing key, the exact sum (as text) one that occurs twice more.
    """
    hashed = F.conv(F.left(F.md5(F.col(key).cast("string").cast("binary")), F.lit(15)), 16, 10).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count(key).alias("key_count"),
        F.bit_xor(hashed).alias("key_xor"), F.sum(hashed.cast("decimal(38,0)")).cast("string").alias("key_sum"),
        *[c.alias(n) for n, c in measures.items()])
