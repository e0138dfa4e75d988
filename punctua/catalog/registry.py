"""Where the registered queries live."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctua.session import pin_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages",
          "labels")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one data folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, df: DataFrame, *by: str) -> DataFrame:
        """Rows dealt by a key when the table has fewer files than cores; unchanged otherwise.

        As many partitions as the session shuffles into, at least one for each core: a join on the same key needs no second shuffle and none of
        them is merged for its few bytes, as documents are built behind it. Unlike round robin, no task sorts its rows first.
        """
        cores = self.spark.sparkContext.defaultParallelism
        parts = max(cores, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return df.repartition(parts, *by) if len(df.inputFiles()) < cores else df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(pin_utc(spark), folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
