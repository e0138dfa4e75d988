"""Exact quantiles with linear interpolation, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["quantiles"]

_BINS = 1024


def _bin(value: Column, low: Column, high: Column) -> Column:
    """Equal-width bin between two bounds; never decreasing in the value."""
    place = F.floor((value - low) / (high - low) * F.lit(_BINS)).cast("int")
    inside = F.greatest(F.lit(0), F.least(place, F.lit(_BINS - 1)))
    return F.when(high > low, inside).otherwise(F.lit(0))


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, passes: int = 2) -> DataFrame:
    """E13. One row per group with a column per probability; NULLs are ignored.

    Values are first counted per distinct value (map-side combined). Each pass then counts at most
    1,024 equal-width bins per group and keeps only the bins that hold a wanted rank, so after two
    passes a millionth of the range is left to order. Groups may be of any size.
    """
    by, names = list(by), list(names or [f"p{p:g}" for p in probs])

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - F.lit(1))

    ranks = [rank(position(p)) for p in probs for rank in (F.floor, F.ceil)]
    counts = (df.where(F.col(col).isNotNull())
              .groupBy(*by, F.col(col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    # Grouping columns may be NULL, and NULL keys must still meet in the joins, so they are wrapped.
    cell = [f"_k{i}" for i in range(len(by))] or ["_all"]
    counts = counts.select(*([F.struct(F.col(c).alias("k")).alias(k) for k, c in zip(cell, by)] or
                             [F.lit(1).alias("_all")]), "_v", "_n")

    start, row = Window.unboundedPreceding, Window.currentRow
    span = counts.groupBy(*cell).agg(F.sum("_n").alias("_total"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    rows = counts.join(span.withColumn("_start", F.lit(0).cast("long")), cell)
    keys = list(cell)
    for i in range(passes):
        binned = rows.withColumn(f"_b{i}", _bin(F.col("_v"), F.col("_low"), F.col("_high")))
        outer, cell = cell, [*cell, f"_b{i}"]
        sizes = binned.groupBy(*cell).agg(
            F.sum("_n").alias("_size"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
            F.max("_total").alias("_total"), F.max("_start").alias("_from"))
        upto = F.sum("_size").over(Window.partitionBy(*outer).orderBy(f"_b{i}").rowsBetween(start, row))
        placed = sizes.withColumn("_start", F.col("_from") + upto - F.col("_size"))
        wanted = F.exists(F.array(*ranks), lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_size")))
        rows = binned.select(*cell, "_v", "_n").join(
            placed.where(wanted).select(*cell, "_total", "_low", "_high", "_start"), cell)

    end = F.col("_start") + F.sum("_n").over(Window.partitionBy(*cell).orderBy("_v").rowsBetween(start, row))
    ordered = rows.withColumn("_end", end)
    found = ordered.groupBy(*keys).agg(F.max("_total").alias("_total"), *[
        F.max(F.when((r >= F.col("_end") - F.col("_n")) & (r < F.col("_end")), F.col("_v"))).alias(f"_at{i}")
        for i, r in enumerate(ranks)])
    result = []
    for i, (p, name) in enumerate(zip(probs, names)):
        low, high, at = F.col(f"_at{2 * i}"), F.col(f"_at{2 * i + 1}"), position(p)
        result.append((low + (at - F.floor(at)) * (high - low)).alias(name))
    return found.select(*[F.col(f"{k}.k").alias(c) for k, c in zip(keys, by)], *result)
