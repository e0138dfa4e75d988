"""Keep one row per key.

Both operators reduce on the map side, so a key that holds a large share of the rows sends one
row per map task through the shuffle rather than all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["collapse_parts", "collapse_with_count", "latest_by"]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """F1, F3, F5. The first row per key under ``order``; NULL keys form one group.

    Spell NULL placement out in ``order`` (``desc_nulls_last``) and end it with a tie-break. The
    ``rank == 1`` filter lets Spark cut each map task down to one row per key before the shuffle.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def _collapse(df: DataFrame, keys: Sequence[str], first_by: Sequence[str], count: Column, count_name: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, count_name)]
    order = F.struct(*[x for c in first_by for x in (F.col(c).isNull(), F.col(c))])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), order).alias("_first"), count.alias(count_name))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns if c != count_name], count_name)
    )


def collapse_with_count(df: DataFrame, keys: Sequence[str], first_by: Sequence[str],
                        count_name: str = "label_count") -> DataFrame:
    """F2. One row per key (smallest ``first_by``, NULLs last) plus how many rows it stood for."""
    return _collapse(df, keys, first_by, F.count(F.lit(1)), count_name)


def collapse_parts(parts: DataFrame, keys: Sequence[str], first_by: Sequence[str], count_name: str = "label_count") -> DataFrame:
    """F2. What ``collapse_with_count`` gives for all rows, from what it gave for parts of them."""
    return _collapse(parts, keys, first_by, F.sum(count_name), count_name)
