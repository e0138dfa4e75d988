"""Intervals and tests that have a closed form over grouped counts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from punctua.operators.quantiles import quantiles

__all__ = ["holm", "interval_side", "normal_p", "percentile_interval", "power", "two_proportion_z", "wilson_interval"]

Z95 = NormalDist().inv_cdf(0.975)


def wilson_interval(df: DataFrame, late: str = "late", n: str = "rows", z: float = Z95) -> DataFrame:
    """L1. Wilson score interval per group, from counts."""
    count, share = F.col(n).cast("double"), F.col(late).cast("double") / F.col(n)
    scale = F.lit(1.0) + z * z / count
    centre = (share + z * z / (count * 2)) / scale
    half = F.lit(z) * F.sqrt(share * (F.lit(1.0) - share) / count + z * z / (count * count * 4)) / scale
    return df.withColumns({"ci_low": centre - half, "ci_high": centre + half})


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a normal statistic. Used on result tables, never on data rows."""
    return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2.0)) if x is not None and x == x else None)


def two_proportion_z(counts: DataFrame, group: str, base, late: str = "late", n: str = "rows") -> DataFrame:
    """L2. One group against each other group: pooled z statistic and its two-sided p-value.

    ``counts`` has one row per group; the base is read as two scalars, so nothing is joined.
    """
    base_row = counts.where(F.col(group) == F.lit(base))
    k0, n0 = [base_row.select(F.col(c).cast("double")).scalar() for c in (late, n)]
    k1, n1 = F.col(late).cast("double"), F.col(n).cast("double")
    pooled = (k0 + k1) / (n0 + n1)
    z = (k0 / n0 - k1 / n1) / F.sqrt(pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / n0 + F.lit(1.0) / n1))
    return (counts.where(F.col(group) != F.lit(base))
            .select(group, F.col(n).alias("rows"), (k1 / n1).alias("rate"), (k0 / n0).alias("base_rate"), z.alias("z"))
            .withColumn("p_value", normal_p("z")))


def holm(df: DataFrame, p: str = "p_value", by: Sequence[str] = (), name: str = "holm_p") -> DataFrame:
    """L9. Holm-adjusted p-values within each family of tests.

    A family is the handful of comparisons of one model; it is small by construction.
    """
    family = [F.col(c) for c in by] or [F.lit(0)]
    ordered = Window.partitionBy(*family).orderBy(p)
    m = F.count(F.lit(1)).over(Window.partitionBy(*family))
    scaled = df.withColumn("_scaled", (m - F.row_number().over(ordered) + 1) * F.col(p))
    return scaled.withColumn(name, F.least(F.lit(1.0), F.max("_scaled").over(
        ordered.rowsBetween(Window.unboundedPreceding, 0)))).drop("_scaled")


def interval_side(low: Column | str, high: Column | str) -> Column:
    """L20. +1 for an interval above 1, -1 for one below, 0 for one that holds 1."""
    lo, hi = (F.col(c) if isinstance(c, str) else c for c in (low, high))
    return F.when(lo > 1, 1).when(hi < 1, -1).otherwise(0)


def percentile_interval(draws: DataFrame, value: str, by: Sequence[str], level: float = 0.95) -> DataFrame:
    """L11. The middle share of the values per group, whatever their number."""
    tail = (1 - level) / 2
    return quantiles(draws, value, [tail, 1 - tail], by, ["boot_low", "boot_high"])


def power(odds_ratio: float, ci_low: float, ci_high: float, n_ratio: float) -> float:
    """L17. Chance that a repeat with ``1 / n_ratio`` of the clusters clears 1, if the estimate is true."""
    se = (math.log(ci_high) - math.log(ci_low)) / (2 * 1.96) * math.sqrt(n_ratio)
    return 1 - NormalDist().cdf(1.96 - math.log(odds_ratio) / se)
