"""Filters, joins and set operations that carry a rule of their own.

No join is hinted: Spark broadcasts a side only below its size threshold and otherwise splits hot
keys at run time (adaptive skew join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "assert_sample", "distinct_values", "gate_columns", "holdout_before", "identified", "in_scope", "join_ranked",
    "last_days", "left_from_dim", "mark_members", "missing_members", "one_row", "rare_to_other", "sample_window",
    "semi", "threshold_flags", "top_k", "union_keys", "unmapped_values", "having", "measured",
]


def semi(df: DataFrame, members: DataFrame, on: str, member_key: str | None = None) -> DataFrame:
    """D1. Rows whose key is in another table."""
    key = members.select(F.col(member_key or on).alias(on)).where(F.col(on).isNotNull())
    return df.join(key, on, "left_semi")


def in_scope(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """C1. Rows whose key belongs to the scope dimension."""
    return semi(df, dim, key, dim_key)


def mark_members(df: DataFrame, members: DataFrame, on: str, member_key: str, name: str) -> DataFrame:
    """Add a flag: does the row's key occur in another table?"""
    known = members.select(F.col(member_key).alias(on)).where(F.col(on).isNotNull()).distinct()
    return (df.join(known.withColumn(name, F.lit(True)), on, "left")
            .select(*df.columns, F.coalesce(F.col(name), F.lit(False)).alias(name)))


def identified(df: DataFrame, *cols: str) -> DataFrame:
    """C2. Rows that carry at least one of the identifiers."""
    return df.where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def measured(df: DataFrame, suspect: str = "has_suspect_times") -> DataFrame:
    """C4. Rows whose measures can be trusted. Counts keep using the full table."""
    return df.where(~F.col(suspect))


def having(aggregated: DataFrame, condition: Column | str) -> DataFrame:
    """C8. Filter on aggregates."""
    return aggregated.where(condition)


def sample_window(df: DataFrame, first: str, last: str, min_hours: float, day: str = "pull_date",
                  hours: str = "hours_before_pull", exclude: str = "is_non_scheduled") -> DataFrame:
    """C5. Batch dates in a closed range, early enough before the pull, scheduled operators only."""
    return df.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
                    & (F.col(hours) >= min_hours) & ~F.col(exclude))


def last_days(df: DataFrame, at: str, days: int) -> DataFrame:
    """C6. Rows of the last days, counted from the newest row of the table itself."""
    newest = df.agg(F.max(at).alias(at)).scalar()
    return df.where(F.col(at) >= newest - F.make_dt_interval(days=F.lit(days)))


def holdout_before(df: DataFrame, day: str, last: str) -> DataFrame:
    """C7. Only batches up to and including a date."""
    return df.where(F.col(day) <= F.lit(last).cast("date"))


def assert_sample(df: DataFrame, expected: Mapping[str, int], measures: Mapping[str, Column]) -> DataFrame:
    """C9. Stop before fitting if the sample is not the one expected."""
    found = df.agg(*[measures[k].alias(k) for k in expected]).first().asDict()
    if found != dict(expected):
        raise AssertionError(f"the sample has changed: expected {dict(expected)}, found {found}")
    return df


def gate_columns(df: DataFrame, flag: str, renames: Mapping[str, str]) -> DataFrame:
    """B24. Blank columns (old name -> new name) wherever one flag is false."""
    gated = {old: F.when(F.col(flag), F.col(old)).alias(new) for old, new in renames.items()}
    return df.select(*[gated.get(c, F.col(c)) for c in df.columns])


def left_from_dim(dim: DataFrame, df: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    """D5. Aggregates per member, starting from the members so that silent ones show up as NULL."""
    per_key = df.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])
    return dim.select(key).distinct().join(per_key, key, "left")


def missing_members(expected: DataFrame, seen: DataFrame, on: str, seen_key: str | None = None) -> DataFrame:
    """D6, G5. Expected rows without a counterpart; a NULL key is not an expectation."""
    return (expected.where(F.col(on).isNotNull())
            .join(seen.select(F.col(seen_key or on).alias(on)).distinct(), on, "left_anti"))


def one_row(base: DataFrame, *more: DataFrame) -> DataFrame:
    """D7. One-row aggregates side by side, as scalar subqueries."""
    return base.select("*", *[d.select(c).scalar().alias(c) for d in more for c in d.columns])


def union_keys(parts: Sequence[DataFrame]) -> DataFrame:
    """G3. Rows of several key variants, by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """G4. Distinct combinations."""
    return df.select(*cols).distinct()


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """G1. First k rows. End ``order`` with a tie-break; each task keeps only its own k."""
    return df.orderBy(*order).limit(k)


def join_ranked(df: DataFrame, by: str, top: int, name: str = "rank") -> DataFrame:
    """D4, F4. Rank of the row's group among the ``top`` biggest groups; all the rest share ``top + 1``.

    Only the top groups are ranked, so the ranking never sorts an open-ended list in one task. Ties go
    to the smaller value. Rows with a NULL group are dropped, as an inner join drops them.
    """
    biggest = top_k(df.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).where(F.col(by).isNotNull()),
                    [F.desc("_n"), F.asc(by)], top)
    ordered = biggest.agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col(by).alias("v")))),
        lambda s: s["v"]).alias("v"))
    place = F.array_position(ordered.scalar(), F.col(by)).cast("int")
    return df.where(F.col(by).isNotNull()).withColumn(name, F.when(place > 0, place).otherwise(F.lit(top + 1)))


def rare_to_other(df: DataFrame, col: str, keep: Sequence[str] | None = None, min_count: int | None = None,
                  name: str = "grouped", other: str = "Other") -> DataFrame:
    """B31. Keep listed or frequent categories, the rest become one."""
    if keep is not None:
        return df.withColumn(name, F.when(F.col(col).isin(*keep), F.col(col)).otherwise(F.lit(other)))
    frequent = (df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count)
                .where(F.col(col).isNotNull()).select(F.col(col).alias("_kept")))
    return (df.join(frequent, F.col(col) == F.col("_kept"), "left")
            .withColumn(name, F.coalesce("_kept", F.lit(other))).drop("_kept"))


def unmapped_values(df: DataFrame, col: str, mapping: Mapping[str, str], among: Column | None = None) -> DataFrame:
    """B29. Values a fixed mapping does not know, with how often they occur."""
    rows = df if among is None else df.where(among)
    return (rows.where(F.col(col).isNotNull() & ~F.col(col).isin(*mapping))
            .groupBy(col).agg(F.count(F.lit(1)).alias("rows")))


def threshold_flags(df: DataFrame, visibility: str = "weather_visibility_m", gust: str = "weather_wind_gust",
                    cap: int = 10_000, low: int = 5_000) -> DataFrame:
    """B30. Capped and low visibility, and whether a gust was reported. Unknown visibility is not low."""
    return (df.withColumn("visibility_capped", F.coalesce(F.col(visibility) >= cap, F.lit(False)))
            .withColumn("low_visibility", F.coalesce(F.col(visibility) < low, F.lit(False)))
            .withColumn("gust_reported", F.col(gust).isNotNull()))
