"""J6. The alert throttle: which check results to announce, without one task ever holding a key's history.

Results are cut into buckets of time. Each bucket is summed up (last wording, last change), a window over these sums hands
every bucket what came before it, and so wording changes and the *runs* between them are found bucket by bucket. Inside a run an
announcement is repeated by the first result later than ``realert_hours`` after the last one. Per block of a run that is a step function from
the time of the last announcement before the block to the last one in it; the functions are composed along the run, and each block
then finds its own announcements from what it is handed. Most runs are short: one of at most ``FOLD`` results is one array, passed over once, so
that no Python group is started for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.config import DEFAULTS
from punctua.plans.health import problem_signature
from punctua.session import scratch

__all__ = ["ALERT_STATE", "throttle", "throttle_alerts"]

BUCKET_SECONDS = 3600
BLOCK = 16  # re-announcement intervals in a block
FOLD = 256  # results of a run that is passed over as one array
ALERT_STATE = "signature STRING, last_at TIMESTAMP_NTZ, held BIGINT"  # besides the key


def _const(table: pa.Table, name: str, n: int) -> pa.Array:
    return table[name].combine_chunks().take(pa.array(np.zeros(n, np.int64)))


def _sorted(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    table = table.sort_by("u")
    return table, table["u"].to_numpy()


def _step_function(table: pa.Table, realert: int, block: int) -> pa.Table:
    """A block as ``entries -> exits``: after a last announcement at ``x`` the first entry over ``x + realert`` is announced and ``exits`` has
    the last announcement of the block. Entries that lead to one exit are kept once (the latest of them)."""
    table, u = _sorted(table)
    m, start = len(u), table["ru"][0].as_py() + table["j"][0].as_py() * block * realert
    after = np.searchsorted(u, u + realert, side="right")
    last, at = np.arange(m), after.copy()
    while (at < m).any():  # at most block + 1 times
        more = at < m
        last[more] = at[more]
        at[more] = after[at[more]]
    usable = np.arange(m) <= np.searchsorted(u, start + realert, side="right")  # the last announcement lies before the block
    keep = np.flatnonzero(usable & np.append((last[1:] != last[:-1]) | ~usable[1:], True))
    names = ["k", "run", "ru", "j"]
    lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (u[keep], u[last[keep]])]
    return pa.table([*[_const(table, n, 1) for n in names], pa.array([int(table["c"].to_numpy().sum())], pa.int64()), *lists], names=[*names, "c", "entries", "exits"])


def _compose(table: pa.Table, realert: int) -> pa.Table:
    """The blocks of one run in order: what each is handed, ``last`` and the results of the run ``before`` it."""
    table = table.sort_by("j")
    last, before, out = table["ru"][0].as_py(), 0, []
    for c, entries, exits in zip(table["c"].to_pylist(), table["entries"].to_pylist(), table["exits"].to_pylist()):
        out.append((last, before))
        i = int(np.searchsorted(entries, last + realert, side="right"))
        last, before = exits[i] if i < len(exits) else last, before + c
    names = ["k", "run", "j"]
    return pa.table([*[table[n].combine_chunks() for n in names], *[pa.array(x, pa.int64()) for x in zip(*out)]], names=[*names, "last", "before"])


def _announced(table: pa.Table, realert: int) -> pa.Table:
    """The announcements of a block: time, detail, and the results of the run before it."""
    table, u = _sorted(table)
    position = table["before"][0].as_py() + np.concatenate([[0], np.cumsum(table["c"].to_numpy())])
    at, last = [], table["last"][0].as_py()
    while (i := int(np.searchsorted(u, last + realert, side="right"))) < len(u):
        at.append(i)
        last = int(u[i])
    rows = table.select(["k", "run", "u", "d"]).take(pa.array(at, pa.int64()))
    return rows.append_column("pos", pa.array(position[at].astype(np.int64)))


def _folded(cells: DataFrame, realert: int) -> DataFrame:
    """The announcements of runs of few results, as ``_announced`` gives them: one pass over the sorted results of a run."""
    runs = cells.groupBy("k", "run", "ru").agg(F.array_sort(F.collect_list(F.struct("u", "c", "d"))).alias("cells"))
    none = F.array().cast("array<struct<u: bigint, d: string, pos: bigint>>")

    def step(so_far: Column, cell: Column) -> Column:
        due, said = cell["u"] > so_far["last"] + F.lit(realert), so_far["said"]
        one = F.array(F.struct(cell["u"].alias("u"), cell["d"].alias("d"), so_far["before"].alias("pos")))
        return F.struct(F.when(due, cell["u"]).otherwise(so_far["last"]).alias("last"), (so_far["before"] + cell["c"]).alias("before"),
                        F.when(due, F.concat(said, one)).otherwise(said).alias("said"))

    start = F.struct(F.col("ru").alias("last"), F.lit(0).cast("long").alias("before"), none.alias("said"))
    return runs.select("k", "run", F.inline(F.aggregate("cells", start, step)["said"]))


def _by_blocks(cells: DataFrame, realert: int, block: int) -> DataFrame:
    """The announcements of runs of any length, block by block.

    Groups are dealt into as many tasks as the session shuffles into, at least one for each core: they cost time each, not bytes, by which Spark would
    merge them all into one task.
    """
    spark = cells.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = f"k {cells.schema['k'].dataType.simpleString()}, run string"
    cells = cells.withColumn("j", F.floor((F.col("u") - F.col("ru")) / (block * realert)))
    functions = cells.repartition(parts, "k", "run", "j").groupBy("k", "run", "j").applyInArrow(
        lambda table: _step_function(table, realert, block), f"{ids}, ru long, j long, c long, entries array<long>, exits array<long>")
    handed = functions.repartition(parts, "k", "run").groupBy("k", "run").applyInArrow(
        lambda table: _compose(table, realert), f"{ids}, j long, last long, before long")
    return cells.join(handed, ["k", "run", "j"]).repartition(parts, "k", "run", "j").groupBy("k", "run", "j").applyInArrow(
        lambda table: _announced(table, realert), f"{ids}, u long, d string, pos long")


def _runs(points: DataFrame, open_before: DataFrame) -> DataFrame:
    """``points`` with the run each belongs to, ``kind`` where it announces a change, and the run before that change.

    A point has a key, a time in microseconds, a wording and a count; ``k`` may be null inside its struct.
    """
    points = points.withColumn("b", F.floor(F.col("u") / (BUCKET_SECONDS * 1_000_000)))
    order = F.struct("u", "late", "d")
    inside = Window.partitionBy("k", "b").orderBy("u", "late", F.asc_nulls_first("d"))
    along = Window.partitionBy("k").orderBy("b")
    wording = F.struct(F.col("s"), F.col("s").isNotNull().alias("open"))
    sums = points.groupBy("k", "b").agg(F.max_by(wording, order).alias("closing"))
    sums = (sums.join(open_before.select("k", F.lit(True).alias("untimed")), "k", "left")
            .withColumn("untimed", F.when(F.col("untimed"), F.struct(F.lit(None).cast("string").alias("s"), F.lit(True).alias("open")))))
    sums = sums.select("k", "b", F.coalesce(F.lag("closing").over(along), "untimed").alias("opening"))
    points = points.withColumn("before", F.lag(wording).over(inside)).join(sums, ["k", "b"])
    before = F.coalesce("before", "opening")
    changed = before.isNull() | ~before["s"].eqNullSafe(F.col("s")) | (before["open"] & F.col("s").isNull())
    points = points.withColumn("start", F.when(changed, order)).withColumn(
        "kind", F.when(~changed | ~F.col("late"), None).when(F.col("s").isNotNull(), "alert").when(before["open"], "recovered")).drop("before", "opening")
    starts = points.groupBy("k", "b").agg(F.max("start").alias("latest"))
    starts = starts.select("k", "b", F.max("latest").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    upto, prior = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    points = points.withColumns({"own": F.max("start").over(upto), "former": F.max("start").over(prior)}).join(starts, ["k", "b"])
    run, former = F.coalesce("own", "earlier"), F.coalesce("former", "earlier")
    return points.select("k", "u", "late", "d", "s", "c", "kind", _name(run).alias("run"), run["u"].alias("ru"), F.when(F.col("kind").isNotNull(), _name(former)).alias("former"))


def _name(start: Column) -> Column:
    return F.concat_ws("|", start["u"], start["late"], F.coalesce(F.concat(F.lit("="), start["d"]), F.lit("")))


def throttle(results: DataFrame, key: str = "check", at: str = "checked_at", detail: str = "detail",
             realert_hours: float = DEFAULTS.realert_hours, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """J6. ``(alerts, state)`` of check results that follow ``state`` (``key`` and ``ALERT_STATE``; none at the start).

    A state row stands for the last announcement and the repeats held back since, so it enters as a result of that weight which announces nothing.
    """
    realert, block = int(realert_hours * 3_600_000_000), BLOCK
    time = results.schema[at].dataType
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    kept = F.struct(F.col(key).alias("key"))
    rows = results.select(kept.alias("k"), micros(F.col(at)).alias("u"), F.col(detail).alias("d"), problem_signature(detail).alias("s"))
    untimed = rows.where("u is null and s is not null")
    timed = rows.where("u is not null").groupBy("k", "u", "d", "s").agg(F.count(F.lit(1)).alias("c")).withColumn("late", F.lit(True))
    open_before = untimed.select("k", "s")
    if state is not None:
        prior = state.select(kept.alias("k"), micros(F.col("last_at")).alias("u"), F.lit(None).cast("string").alias("d"), F.col("signature").alias("s"),
                             (F.col("held") + 1).alias("c"), F.lit(False).alias("late"))
        touched = timed.select("k").union(untimed.select("k")).distinct()
        prior = scratch(prior.join(touched, "k", "left_semi"), "throttle-state")
        timed = timed.unionByName(prior.where("u is not null"))
        open_before = open_before.union(prior.where("u is null").select("k", "s"))
    points = scratch(_runs(timed, open_before.groupBy("k").agg(F.max("s").alias("s"))), "throttle-points")

    problems = points.where("s is not null")
    runs = problems.groupBy("k", "run", "ru").agg(F.sum("c").alias("total"), F.max("u").alias("newest"), F.min("s").alias("s"), F.count(F.lit(1)).alias("n"))
    runs = scratch(runs, "throttle-runs")
    long = runs.where(F.col("newest") > F.col("ru") + realert).select("k", "run", (F.col("n") <= FOLD).alias("few"))
    cells = problems.join(long, ["k", "run"]).groupBy("k", "run", "ru", "u").agg(F.sum("c").alias("c"), F.min("d").alias("d"), F.first("few").alias("few"))
    cells = scratch(cells, "throttle-cells")
    again = scratch(_folded(cells.where("few"), realert).unionByName(_by_blocks(cells.where("not few").drop("few"), realert, block)), "throttle-again")

    ends = again.groupBy("k", "run").agg(F.max("pos").alias("pos"), F.max("u").alias("last"))
    ends = runs.join(ends, ["k", "run"], "left").select(
        "k", "run", "ru", "s", F.coalesce("last", "ru").alias("last"), (F.col("total") - F.coalesce("pos", F.lit(0)) - 1).alias("held"))
    changes = points.where("kind is not null").alias("p").join(
        ends.alias("e"), (F.col("p.k") == F.col("e.k")) & (F.col("p.former") == F.col("e.run")), "left").select(
        "p.k", "p.kind", "p.u", "p.d", F.coalesce("e.held", F.lit(0)).alias("suppressed"))
    since = F.lag("pos", 1, 0).over(Window.partitionBy("k", "run").orderBy("u"))
    repeats = again.select("k", F.lit("alert").alias("kind"), "u", "d", (F.col("pos") - since - 1).alias("suppressed"))
    first = untimed.select("k", F.lit("alert").alias("kind"), "u", "d", F.lit(0).cast("long").alias("suppressed"))
    said = changes.unionByName(repeats).unionByName(first)
    alerts = said.select(F.col("k.key").alias(key), "kind", F.timestamp_micros("u").cast(time).alias(at), F.col("d").alias("detail"), "suppressed")

    closing = points.groupBy("k").agg(F.max_by(F.struct("run", "s"), F.struct("u", "late", "d")).alias("x")).select("k", F.col("x.run").alias("run"), F.col("x.s").alias("s"))
    after = closing.join(ends.select("k", "run", "last", "held"), ["k", "run"], "left").where("s is not null").select(
        F.col("k.key").alias(key), F.col("s").alias("signature"), F.timestamp_micros("last").cast("timestamp_ntz").alias("last_at"), "held")
    only = open_before.join(points.select("k").distinct(), "k", "left_anti").groupBy("k").agg(F.max("s").alias("signature"))
    after = after.unionByName(only.select(F.col("k.key").alias(key), "signature", F.lit(None).cast("timestamp_ntz").alias("last_at"), F.lit(0).cast("long").alias("held")))
    return alerts, after


def throttle_alerts(results: DataFrame, key: str = "check", at: str = "checked_at", detail: str = "detail",
                    realert_hours: float = DEFAULTS.realert_hours) -> DataFrame:
    """J6. Which check results to announce, and how many repeats each announcement stands for.

    A new problem is announced at once, again when its wording changes, and otherwise at most every
    ``realert_hours``; the end of a problem is announced once. Every result counts, in order of time and, at one
    time, of wording (no problem first). A NULL key is a key of its own; results without a time come first, and each problem
    among them is announced.
    """
    return throttle(results, key, at, detail, realert_hours)[0]
