"""Alerts on streams: the throttle, and members that fall silent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from punctua.config import DEFAULTS
from punctua.plans.throttle import throttle
from punctua.session import scratch
from punctua.sources.commits import CommitLog
from punctua.streaming.loads import catch_up

__all__ = ["start_throttle", "throttle_batch", "watch_silence"]


def throttle_batch(log: CommitLog, batch: DataFrame, loader: str, batch_id: int, key: str = "check", at: str = "checked_at", detail: str = "detail",
                   realert_hours: float = DEFAULTS.realert_hours) -> bool:
    """J6. Take one batch of check results: its announcements and the new state of its keys become visible together; False if it was taken before."""
    while True:
        now = log.snapshot()
        if now.done(loader, batch_id):
            return False
        kept = now.read("state")
        alerts, after = throttle(batch, key, at, detail, realert_hours, kept)
        if kept is not None:  # keys without results keep what they have
            touched = batch.select(F.struct(F.col(key)).alias("_k")).distinct()
            after = after.unionByName(kept.join(touched, F.struct(F.col(key)) == F.col("_k"), "left_anti"))
        paths = {"alerts": log.write(alerts, "alerts")[0], "state": log.write(after, "state")[0]}
        if log.commit(now.version + 1, paths, loader, batch_id, replaces=("state",)):
            return True


def start_throttle(stream: DataFrame, log: CommitLog, loader: str, checkpoint: str, key: str = "check", at: str = "checked_at", detail: str = "detail",
                   realert_hours: float = DEFAULTS.realert_hours) -> StreamingQuery:
    """J6. ``throttle_alerts`` over a stream of check results; a key of any size is worked off in blocks, as in the batch form.

    Batches must arrive in time order per key, as check results do. Within a batch, order does not matter.
    """
    return catch_up(stream, checkpoint, lambda batch, i: throttle_batch(log, scratch(batch, "throttle-batch"), loader, i, key, at, detail, realert_hours))


def _runs_of(times: np.ndarray, limit: int, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of times with no gap over ``limit``, those of ``runs`` merged in: memory grows with the silences, not with the rows."""
    times = np.sort(times)
    cut = np.flatnonzero(np.diff(times) > limit) + 1
    spans = sorted([*runs, *((int(x[0]), int(x[-1])) for x in np.split(times, cut) if len(x))])
    out: list[tuple[int, int]] = []
    for low, high in spans:
        if out and low - out[-1][1] <= limit:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


class _Silence(StatefulProcessor):
    """State per member: when it was last heard (or expected from), and whether it counts as silent. Times in microseconds."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("heard", "last LONG, silent BOOLEAN")

    def _due(self, last: int) -> int:
        return -(-(last + self.limit) // 1000)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        last = int(initialState["since"].iloc[0])
        self.state.update((last, False))
        self.handle.registerTimer(self._due(last))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs: list[tuple[int, int]] = []
        for part in rows:
            runs = _runs_of(part["heard_at"].dropna().to_numpy(np.int64), self.limit, runs)
        known = self.state.get() if self.state.exists() else None
        last, silent, said = (known[0], known[1], []) if known else (None, False, [])
        first = last
        for low, high in runs:
            if last is not None and (silent or low > last + self.limit):
                if not silent:
                    said.append(("silent", last + self.limit, last))
                said.append(("recovered", low, last))
                silent = False
            last = high if last is None else max(last, high)
        if last is not None and last != first:
            if first is not None:
                self.handle.deleteTimer(self._due(first))
            self.state.update((last, silent))
            self.handle.registerTimer(self._due(last))
        yield self._frame(key, said)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, silent = self.state.get()
        said = [] if silent or self._due(last) != expiredTimerInfo.getExpiryTimeInMs() else [("silent", last + self.limit, last)]
        if said:
            self.state.update((last, True))
        yield self._frame(key, said)

    @staticmethod
    def _frame(key, said) -> pd.DataFrame:
        out = pd.DataFrame(said, columns=["kind", "at", "last"])
        out.insert(0, "member", key[0])
        return out


def watch_silence(stream: DataFrame, expected: DataFrame, key: str, at: str, since: str, limit_hours: float, delay: str) -> DataFrame:
    """J2, J3. A stream of ``key, kind, at, last_heard``: ``silent`` once a member has not been heard for ``limit_hours``, ``recovered`` when it is heard again.

    ``expected`` (``key, since``) seeds a timer for every member, so one that never delivers is reported too, and one that stops is reported
    while nothing of it arrives: its timer fires when the time of the other members' data has passed it by ``delay``. Members that are not expected are watched
    from their first row. Rows later than ``delay`` are left out by the watermark; ``delay`` should not be longer than the limit. Gaps inside a batch are reported
    as if each row had come alone, so the result does not depend on how rows are cut into batches. Needs the RocksDB state store.
    """
    limit = int(limit_hours * 3_600_000_000)
    kind = dict(stream.dtypes)[key]
    rows = (stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
            .select(F.col(key).alias("member"), "_at", F.unix_micros("_at").alias("heard_at")))
    seeds = expected.select(F.col(key).alias("member"), F.unix_micros(F.col(since).cast("timestamp")).alias("since")).groupBy("member").agg(F.min("since").alias("since"))
    said = rows.groupBy("member").transformWithStateInPandas(
        _Silence(limit), f"member {kind}, kind string, at long, last long", "append", "EventTime", seeds.groupBy("member"))
    return said.select(F.col("member").alias(key), "kind", F.timestamp_micros("at").cast("timestamp_ntz").alias("at"),
                       F.timestamp_micros("last").cast("timestamp_ntz").alias("last_heard"))
