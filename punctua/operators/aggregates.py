"""Grouped aggregates shared by the reports and the analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions import flag, safe_rate
from punctua.operators.quantiles import quantiles
from punctua.operators.relational import top_k

__all__ = [
    "busiest", "correlation", "counts", "crosstab", "daily_average", "data_summary", "dense_histogram",
    "distinct_count", "group_sizes", "missing_counts", "pivot_stat", "rate_by", "slice_counts", "tail_counts",
    "with_and_without",
]


def counts(df: DataFrame, by: Sequence[str | Column], name: str = "rows") -> DataFrame:
    """E7, E16. Row counts per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def rate_by(df: DataFrame, by: Sequence[str], outcome: str | Column, total: str = "rows", hits: str = "late",
            rate: str = "late_rate") -> DataFrame:
    """E10. Rows, hits and their share per group. The outcome is a boolean or a 0/1 column."""
    hit = F.col(outcome) if isinstance(outcome, str) else outcome
    hit = flag(hit.cast("boolean"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(total), F.count_if(hit).alias(hits),
        (F.count_if(hit).cast("double") / F.count(F.lit(1))).alias(rate))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, normalize: bool = False,
             names: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """E11. Counts (or row shares) with a fixed list of columns, zero where empty.

    The values are given, so no extra job has to find them. Shares are of the whole row,
    values outside the list included; rows with a NULL column value do not count.
    """
    names = list(names or [str(v) for v in values])
    total = F.count(F.col(col))

    def cell(v) -> Column:
        n = F.count_if(F.col(col) == F.lit(v))
        return safe_rate(n, total, digits, scale=1.0) if normalize else n

    return df.groupBy(row).agg(*[cell(v).alias(n) for v, n in zip(values, names)])


def pivot_stat(df: DataFrame, row: str, col: str, value: str, values: Sequence, stat: str = "mean",
               min_n: int = 0, names: Sequence[str] | None = None) -> DataFrame:
    """E12, L21. Mean, count or median per cell; cells with fewer than ``min_n`` values are blank."""
    names = list(names or [str(v) for v in values])
    number = F.col(value).cast("double")

    def cell(v) -> Column:
        here = F.when(F.col(col) == F.lit(v), number)
        n = F.count(here)
        return F.when(n >= min_n, n if stat == "count" else F.avg(here))

    if stat in ("mean", "count"):
        return df.groupBy(row).agg(*[cell(v).alias(n) for v, n in zip(values, names)])
    if stat != "median":
        raise ValueError(f"unknown statistic {stat!r}")
    medians = quantiles(df, value, [0.5], [row, col], ["_m"])
    sizes = df.groupBy(row, col).agg(F.count(value).alias("_n"))
    cells = sizes.join(medians, [row, col])
    return df.select(row).distinct().join(
        cells.groupBy(row).agg(*[
            F.max(F.when((F.col(col) == F.lit(v)) & (F.col("_n") >= min_n), F.col("_m"))).alias(n)
            for v, n in zip(values, names)]), row, "left")


def correlation(df: DataFrame, a: str, b: str, name: str = "correlation", by: Sequence[str] = ()) -> DataFrame:
    """E14. Pearson correlation over the rows where both are known."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by).agg(F.corr(a, b).alias(name))


def distinct_count(df: DataFrame, by: Sequence[str], cols: Sequence[str], name: str = "distinct") -> DataFrame:
    """E15. Distinct combinations per group; a NULL in any column does not count.

    Two steps, so a hot group is reduced on the map side instead of gathering its values in one task.
    """
    return (df.select(*by, *[F.col(c).alias(f"_d{i}") for i, c in enumerate(cols)]).distinct()
            .groupBy(*by).agg(F.count(F.when(
                ~F.greatest(*[F.col(f"_d{i}").isNull() for i in range(len(cols))], F.lit(False)), 1)).alias(name)))


def busiest(df: DataFrame, day: str, name: str = "rows") -> DataFrame:
    """E16. The value with most rows (ties: the smallest) and its share of all rows."""
    per_day = counts(df.where(F.col(day).isNotNull()), [day], name)
    total = df.agg(F.count(F.lit(1)).alias("_all")).scalar()
    return top_k(per_day, [F.desc(name), F.asc(day)], 1).withColumn(
        "share", F.col(name).cast("double") / total)


def with_and_without(df: DataFrame, by: str, outcome: str, day: str) -> DataFrame:
    """E16. Rate per group on all days, and without the busiest one."""
    top = busiest(df, day).select(day).scalar()
    hit = flag(F.col(outcome).cast("boolean")).cast("double")
    return df.groupBy(by).agg(
        F.avg(hit).alias("rate_all"),
        F.avg(F.when(flag(F.col(day) != top) | F.col(day).isNull(), hit)).alias("rate_without_busiest"))


def dense_histogram(df: DataFrame, col: str | Column, low: int, high: int, name: str = "rows",
                    value_name: str = "value") -> DataFrame:
    """E17. Counts for every integer from ``low`` to ``high``, zero where nothing falls."""
    value = (F.col(col) if isinstance(col, str) else col).cast("long")
    seen = df.select(value.alias(value_name)).groupBy(value_name).agg(F.count(F.lit(1)).alias("_n"))
    axis = df.sparkSession.range(low, high + 1).withColumnRenamed("id", value_name)
    return axis.join(seen, value_name, "left").select(
        value_name, F.coalesce("_n", F.lit(0).cast("long")).alias(name))


def group_sizes(df: DataFrame, by: str, batch: str) -> DataFrame:
    """E18. Number of batches per group, and the smallest and largest."""
    return (df.groupBy(by, batch).agg(F.count(F.lit(1)).alias("_n")).groupBy(by)
            .agg(F.count(F.lit(1)).alias("batches"), F.min("_n").alias("smallest"), F.max("_n").alias("largest")))


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E19. Missing values per column, in one scan, as rows."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], [F.col(c) for c in cols], "column", "missing")


def data_summary(df: DataFrame, **measures: Column) -> DataFrame:
    """E20. Any number of measures in one row and one scan."""
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def daily_average(df: DataFrame, key: str, at: str, value: str, name: str = "average",
                  having: Column | None = None) -> DataFrame:
    """E21. Average per key and day, optionally filtered on the average."""
    out = df.groupBy(key, F.col(at).cast("date").alias("day")).agg(F.avg(value).alias(name))
    return out if having is None else out.where(having)


def tail_counts(df: DataFrame, by: str, col: str, cut: float) -> DataFrame:
    """E22. How many rows, how many at or beyond a cut, and the largest."""
    return df.groupBy(by).agg(F.count(col).alias("rows"), F.count_if(F.col(col) >= cut).alias("beyond_cut"),
                              F.max(col).alias("largest"))


def slice_counts(df: DataFrame, condition: Column, by: Sequence[str], name: str = "rows") -> DataFrame:
    """E23. Counts per group inside a slice."""
    return counts(df.where(condition), by, name)
