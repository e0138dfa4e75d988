"""Session helpers. Library functions never set configuration; only entry points do."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "punctua", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PUNCTUA_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> SparkSession:
    """Wall times are read as UTC throughout, so entry points pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside give up their shuffle files when each of them ends, instead of when the driver next collects garbage.

    For entry points that run several jobs, each over a data frame of its own and written at once: a frame that is run again shuffles again.
    """
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@lru_cache(maxsize=1)
def _scratch() -> str:
    """One scratch folder for the whole application, removed when it ends."""
    root = tempfile.mkdtemp(prefix="punctua-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint folder, or a scratch one where none is named.

    Reads ``spark.checkpoint.dir``. A machine-local folder is only ever used in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _scratch()
    return f"{root.rstrip('/')}/{name}-{os.urandom(6).hex()}"


def scratch(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back, for what is read more than once. The folder is added to ``made``, for whoever wants to discard it."""
    path = shared_dir(df.sparkSession, name)
    if made is not None:
        made.append(path)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)
