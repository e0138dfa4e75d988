"""As-of join: the latest right row at or before each left row, per key.

A window over the key alone would put a busy key into one task. Here the work is split by time:

1. Only distinct (key, time) points of the left side take part, so rows that share a time never
   pile up; the wide left rows meet their match in one equi join at the end.
2. Points are grouped by (key, time bucket). A bucket holds at most one point per distinct time
   on each side, so ``bucket_seconds`` bounds its size: 3,600 times two at one-second resolution.
3. Where a bucket has no earlier right row, the answer is the last right row of an earlier bucket.
   That carry runs over bucket summaries in two levels (``fan`` buckets, then the groups of them),
   so no level sorts a whole key.

A right side that is dealt by (key, time bucket) already, as one that was deduplicated by key and time can be, is not shuffled again. Points and bucket
summaries come from one sorted pass, which is redone for each use unless ``tap`` writes its result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.config import DEFAULTS

__all__ = ["Probe", "asof_join", "asof_probes", "carry_forward", "time_bucket"]


def _floor_div(value: Column, by: float) -> Column:
    # Never NULL here. Saying so keeps Spark from adding NULL filters to one use of a shuffle and
    # not to another, which would stop the two from sharing it.
    return F.coalesce(F.floor(value / F.lit(by)), F.lit(0).cast("long"))


def _bucket(at: Column, seconds: float) -> Column:
    return _floor_div(F.unix_micros(at.cast("timestamp")), seconds * 1e6)


def time_bucket(at: Column | str, seconds: float = DEFAULTS.asof_bucket_seconds) -> Column:
    """The bucket of a time; a right side dealt by its key and this column spares ``asof_probes`` a shuffle."""
    return _bucket(F.col(at) if isinstance(at, str) else at, seconds)


def _over(by: Sequence[str], *order: str) -> Window:
    return Window.partitionBy(*by).orderBy(*order)


def _carry(cells: DataFrame, by: list[str], fan: int) -> DataFrame:
    """For every (by, _b) cell, the last ``_r`` of an earlier cell of the same key."""
    start, end = Window.unboundedPreceding, Window.currentRow
    group = _over([*by, "_g"], "_b")
    near = cells.withColumn("_g", _floor_div(F.col("_b"), fan)).withColumns({
        "_near": F.last("_r", ignorenulls=True).over(group.rowsBetween(start, -1)),
        "_upto": F.last("_r", ignorenulls=True).over(group.rowsBetween(start, end)),
        "_closes": F.lead(F.lit(False), 1, True).over(group)})
    far = near.where("_closes").select(
        *by, "_g", F.last("_upto", ignorenulls=True).over(_over(by, "_g").rowsBetween(start, -1)).alias("_far"))
    return near.join(far, [*by, "_g"]).select(*by, "_b", F.coalesce("_near", "_far").alias("_carried"))


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _matches(points: DataFrame, right: DataFrame, by: list[str], right_on: str, take: Sequence[str], bucket_seconds: float,
             fan: int, dealt: str | None, tap: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """(by, _t, _match) for distinct points (by, _t): the struct of ``take`` of the latest right row at or before ``_t``."""
    readings = (
        right.where(_all_of([F.col(c).isNotNull() for c in [*by, right_on]]))
        .select(*by, F.col(right_on).alias("_t"), F.struct(*take).alias("_r"),
                (F.col(dealt) if dealt else _bucket(F.col(right_on), bucket_seconds)).alias("_b"))
    )
    points = points.withColumns({"_b": _bucket(F.col("_t"), bucket_seconds), "_is_left": F.lit(True)})
    timeline = readings.withColumn("_is_left", F.lit(False)).unionByName(
        points.repartition(*by, "_b") if dealt else points, allowMissingColumns=True)

    # A right row at the very same time counts, so it sorts first. The placed points and the bucket
    # summaries come from one sorted pass, so both read the same shuffle.
    bucket = _over([*by, "_b"], "_t", "_is_left")
    swept = timeline.withColumns({
        "_here": F.last("_r", ignorenulls=True).over(
            bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_closes": F.lead(F.lit(False), 1, True).over(bucket)})
    if tap is not None:
        swept = tap(swept.where(F.col("_is_left") | F.col("_closes")).drop("_r"))
    placed = swept.where("_is_left").select(*by, "_b", "_t", "_here")
    cells = swept.where("_closes").select(*by, "_b", F.col("_here").alias("_r"))
    return placed.join(_carry(cells, by, fan), [*by, "_b"]).select(*by, "_t", F.coalesce("_here", "_carried").alias("_match"))


@dataclass(frozen=True)
class Probe:
    """One time column of the left side, and what its match adds: {new column: right column}."""

    left_on: str
    take: Mapping[str, str]
    tolerance_seconds: float | None = None


def asof_probes(left: DataFrame, right: DataFrame, by: Sequence[str], right_on: str, probes: Sequence[Probe],
                bucket_seconds: float = DEFAULTS.asof_bucket_seconds, fan: int = DEFAULTS.asof_fan,
                dealt: str | None = None, tap: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D2, D3, L16. Several as-of joins with one right side: every left row, with the matches of each of its time columns.

    All time columns become points of one timeline, so the right side is read, shuffled and sorted once however many probes there are; each
    probe then costs one equi join. Rules for missing keys and times, the look-back, and the tolerance are those of ``asof_join``. ``dealt`` names the column
    with the ``time_bucket`` by which, and by the key, right rows are dealt already. ``tap`` sees the points and the last row of each bucket, which
    are read once for each probe and once more for the carry: a function that writes and re-reads them saves as many sorts of the right side.
    """
    by = list(by)
    at = F.filter(F.array(*[F.col(p.left_on) for p in probes]), lambda t: t.isNotNull())
    points = (left.where(_all_of([F.col(c).isNotNull() for c in by]))
              .select(*by, F.explode(F.array_distinct(at)).alias("_t")).distinct())
    take = list(dict.fromkeys([right_on, *[c for p in probes for c in p.take.values()]]))
    matched = _matches(points, right, by, right_on, take, bucket_seconds, fan, dealt, tap)
    out = left
    for i, p in enumerate(probes):
        match = F.col("_match")
        if p.tolerance_seconds is not None:
            elapsed = F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col(f"_match.{right_on}").cast("timestamp"))
            match = F.when(elapsed <= F.lit(int(p.tolerance_seconds * 1_000_000)), match)
        out = out.join(matched.select(*by, F.col("_t").alias(p.left_on), match.alias(f"_match{i}")), [*by, p.left_on], "left")
    return out.select(*[F.col(c) for c in left.columns],
                      *[F.col(f"_match{i}.{c}").alias(name) for i, p in enumerate(probes) for name, c in p.take.items()])


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
              take: Sequence[str] = (), tolerance_seconds: float | None = None,
              bucket_seconds: float = DEFAULTS.asof_bucket_seconds, fan: int = DEFAULTS.asof_fan) -> DataFrame:
    """D2, D3. Every left row, with ``right_on`` and ``take`` of its latest right row at or before it.

    The look-back is unbounded unless ``tolerance_seconds`` (elapsed, inclusive) is given. Left rows
    with a NULL key or time are kept, unmatched. The right side needs one row per (by, right_on);
    ``latest_by`` gives that.
    """
    return asof_probes(left, right, by, right_on, [Probe(left_on, {c: c for c in (right_on, *take)}, tolerance_seconds)], bucket_seconds, fan)


def carry_forward(df: DataFrame, by: Sequence[str], at: str, col: str, tie: str, name: str | None = None) -> DataFrame:
    """F6. Last known value of ``col`` at or before each row's time; NULL values are skipped.

    Rows of one time are in order of ``tie``: a row sees values up to its own. Earlier times come from an as-of join of the
    table with its own known values (moved on by a microsecond, the finest step of a timestamp), so a long series is split by time
    instead of sorted as one group; only rows that share a time are sorted together.
    """
    known = df.where(F.col(col).isNotNull()).groupBy(*by, (F.col(at) + F.expr("INTERVAL '0.000001' SECOND")).alias("_known_at")).agg(
        F.max_by(col, tie).alias("_known"))
    together = Window.partitionBy(*by, at).orderBy(tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = df.withColumn("_seen", F.last(col, ignorenulls=True).over(together))
    carried = asof_join(seen, known, by, at, "_known_at", ["_known"])
    return carried.withColumn(name or col, F.coalesce("_seen", "_known")).drop("_known_at", "_known", "_seen")
