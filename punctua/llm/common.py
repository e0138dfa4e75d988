"""Helpers shared by the corpus operators: written intermediate tables and native word expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.session import shared_dir

WORD_GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARS = " \t\n\x0b\f\r"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, survives a lost executor, and lets Spark plan later joins with the real size.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts give an empty array."""
    bare = F.trim(text, F.lit(_GAP_CHARS))
    return F.when(bare != "", F.split(bare, WORD_GAP)).otherwise(F.array().cast("array<string>"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also when ``use`` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def shingle_hash(tokens: Column, at: Column, width: int) -> Column:
    """64-bit hash of ``width`` words from position ``at``; words past the end are left out."""
    return F.xxhash64(*[F.get(tokens, at + i) for i in range(width)])


def starts(tokens: Column, width: int) -> Column:
    """Start positions of the shingles of ``tokens``: one shingle if there are fewer words than ``width``, none without words."""
    n = F.size(tokens)
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))).otherwise(F.array().cast("array<int>"))
