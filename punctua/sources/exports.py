"""Seeds and typed CSV exports."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["parse_by_suffix", "read_seed", "read_table_or_export"]

AIRPORT_SEED = "iata_code STRING, airport_name STRING, city STRING, latitude DOUBLE, longitude DOUBLE"
_TIME_SUFFIXES = ("_local", "_utc", "_at")


def read_seed(spark: SparkSession, path: str, schema: str = AIRPORT_SEED) -> DataFrame:
    """A8. A small CSV with a header, as a dimension and as the only list of what is in scope."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def parse_by_suffix(df: DataFrame, date_columns: tuple[str, ...] = ("flight_date",)) -> DataFrame:
    """A10. Lower-case names; columns named ``*_local``, ``*_utc`` or ``*_at`` become wall times."""
    out = df.toDF(*[c.lower() for c in df.columns])
    return out.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if c.endswith(_TIME_SUFFIXES)
        else F.col(c).cast("date").alias(c) if c in date_columns else F.col(c)
        for c in out.columns
    ])


def read_table_or_export(spark: SparkSession, read: Callable[[], DataFrame], export_path: str, schema: str,
                         unavailable: tuple[str, ...] = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")) -> DataFrame:
    """A10. The live table, or its CSV export (announced loudly) when the table cannot be reached.

    Only a missing table falls back. A query that is wrong fails, rather than quietly reading old data.
    """
    try:
        return parse_by_suffix(read())
    except PySparkException as error:
        if error.getCondition() not in unavailable:
            raise
        warnings.warn(f"table unavailable ({error.getCondition()}); using the export {export_path}", stacklevel=2)
        return parse_by_suffix(spark.read.schema(schema).csv(export_path, header=True))
