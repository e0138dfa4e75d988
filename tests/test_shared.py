"""Tables shared by several writers, and alerts over time."""

import importlib
import random
import re
import threading
from datetime import datetime, timedelta

import pytest
from landing_files import airports, documents, flight, reading
from pyspark.sql import functions as F
from test_fact import epoch, key

from punctua.config import DEFAULTS
from punctua import plans, sources, streaming

throttle_module = importlib.import_module("punctua.plans.throttle")
refresh_module = importlib.import_module("punctua.streaming.refresh")

T0 = datetime(2026, 9, 1)
RESULT = "check STRING, checked_at TIMESTAMP_NTZ, detail STRING"


def files(spark, names):
    return spark.createDataFrame([('{"data": []}' if "bad" not in n else "<html>", n) for n in names], "raw_data STRING, source_file STRING")


def loaded(log):
    return sorted(r.source_file for r in log.snapshot().read("raw").collect())


def test_one_version_has_one_owner(spark, tmp_path):
    log = sources.CommitLog(spark, str(tmp_path / "t"))
    won, start = [], threading.Barrier(8)

    def race(n):
        start.wait()
        if log.commit(0, {"t": f"folder-{n}"}, f"loader-{n}", 0):
            won.append(n)

    threads = [threading.Thread(target=race, args=(n,)) for n in range(8)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert len(won) == 1 and log.snapshot().paths == {"t": (f"folder-{won[0]}",)} and log.snapshot().loaders == {f"loader-{won[0]}": 0}


def test_overlapping_loaders_give_each_file_once(spark, tmp_path):
    log = sources.CommitLog(spark, str(tmp_path / "t"))
    # while a has written but not committed, b loads a part of the same files
    between = lambda: sources.load_shared(files(spark, ["f2", "f3", "f4"]), log, "b", 0)
    assert sources.load_shared(files(spark, ["f1", "f2", "f3", "bad"]), log, "a", 0, before_commit=between) == 1
    assert loaded(log) == ["bad", "f1", "f2", "f3", "f4"]
    assert sources.load_shared(files(spark, ["f1", "f5"]), log, "a", 0) is None  # a replayed batch, whatever it holds
    assert sources.load_shared(files(spark, ["f1", "f4"]), log, "c") is None and loaded(log) == ["bad", "f1", "f2", "f3", "f4"]
    assert [r.status for r in log.snapshot().read("raw").where("source_file = 'bad'").collect()] == ["LOAD_FAILED"]


def test_a_loader_killed_before_its_commit_loads_nothing(spark, tmp_path):
    log = sources.CommitLog(spark, str(tmp_path / "t"))

    def killed():
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        sources.load_shared(files(spark, ["f1"]), log, "a", 0, before_commit=killed)
    assert log.snapshot().read("raw") is None
    assert sources.load_shared(files(spark, ["f1", "f2"]), log, "a", 0) == 0 and loaded(log) == ["f1", "f2"]
    assert log.vacuum(older_than_hours=24) == 0 and log.vacuum(older_than_hours=-1) == 1 and loaded(log) == ["f1", "f2"]


def test_streams_with_checkpoints_of_their_own_share_a_table(spark, tmp_path):
    log, land = sources.CommitLog(spark, str(tmp_path / "t")), str(tmp_path / "land")
    for i, names in enumerate((["f1", "f2"], ["f2", "f3"])):
        files(spark, names).coalesce(1).write.parquet(f"{land}/{i}")
        for loader in ("a", "b"):
            stream = spark.readStream.schema("raw_data STRING, source_file STRING").parquet(f"{land}/*")
            streaming.start_shared_load(stream, log, loader, str(tmp_path / loader)).awaitTermination()
    assert loaded(log) == ["f1", "f2", "f3"]


def test_versions_compaction_and_the_gate(spark, tmp_path):
    log, frame = sources.CommitLog(spark, str(tmp_path / "t")), lambda n: spark.range(n).toDF("x")
    fine = lambda found: [] if found["n"] >= 3 else [f"only {found['n']} rows"]
    metrics = {"n": F.count(F.lit(1))}
    assert log.publish(frame(3), "t", metrics, fine) == 0 and log.publish(frame(5), "t", metrics, fine) == 1
    with pytest.raises(sources.GateFailed, match="only 2 rows"):
        log.publish(frame(2), "t", metrics, fine)
    assert log.snapshot().read("t").count() == 5 and log.snapshot(0).read("t").count() == 3
    path, _ = log.write(frame(4), "t")
    assert log.commit(2, {"t": path}) and not log.commit(2, {"t": path})
    assert log.snapshot().read("t").count() == 9 and len(log.snapshot().paths["t"]) == 2
    assert log.compact("t", lambda df: df.distinct()) and log.snapshot().read("t").count() == 5 and len(log.snapshot().paths["t"]) == 1


def staged(spark, first, weather):
    return plans.stage_flights(documents(spark, first)), plans.stage_weather(documents(spark, weather))


def test_refresh_equals_a_rebuild_after_conflicts_and_replays(spark, tmp_path):
    def landed(n, day, arrival, pull=0, dep="10:00:00"):
        return key(n + 100 * pull), {"data": [flight(iata=f"AA{n}", day=f"2026-09-{day}", dep_sched=f"2026-09-{day}T{dep}",
                                                     dep_act=f"2026-09-{day}T{dep}", arr_sched=f"2026-09-{day}T13:00:00", arr_act=arrival)]}

    old = [landed(i, d, f"2026-09-{d}T13:00:00") for i, d in enumerate((14, 16, 18))]
    late = [[landed(0, 14, "2026-09-16T12:40:00", pull=1), landed(7, 15, None)], [landed(8, 16, "2026-09-16T12:50:00")]]
    w = [("raw/weather/a/SFO_1.json", reading(epoch(2026, 9, 14, 19), wind=1.0)),
         ("raw/weather/b/SFO_2.json", reading(epoch(2026, 9, 16, 19, 30), wind=2.0)), ("raw/weather/c/SFO_3.json", reading(epoch(2026, 9, 18, 19, 30), wind=3.0))]
    dim, log = airports(spark), sources.CommitLog(spark, str(tmp_path / "t"))
    flights, weather = staged(spark, old, w[:1])
    streaming.open_fact(log, flights, weather, dim)
    rows = lambda df: sorted(map(str, df.select(*plans.FACT_COLUMNS).collect()))

    def rebuilt(batches, readings):
        return rows(plans.build_fact(*staged(spark, old + [x for b in batches for x in b], readings), dim))

    assert rows(streaming.fact_of(log)) == rebuilt([], w[:1])
    # the weather stream commits between the flight batch's reading and its commit: the batch is worked out again
    commit, once = log.commit, []

    def contested(version, adds, *rest, **more):
        if "flights" in adds and not once:
            once.append(1)
            assert streaming.refresh_batch(log, "weather", staged(spark, old, w[1:2])[1], "weather", 0, dim)
        return commit(version, adds, *rest, **more)

    log.commit = contested
    assert streaming.refresh_batch(log, "flights", staged(spark, late[0], w)[0], "flights", 0, dim)
    log.commit = commit
    assert rows(streaming.fact_of(log)) == rebuilt(late[:1], w[:2])
    assert not streaming.refresh_batch(log, "flights", staged(spark, late[0], w)[0], "flights", 0, dim)
    assert streaming.fold_fact(log) and rows(streaming.fact_of(log)) == rebuilt(late[:1], w[:2])
    assert streaming.refresh_batch(log, "flights", staged(spark, late[1], w)[0], "flights", 1, dim)
    assert streaming.refresh_batch(log, "weather", staged(spark, old, w[2:])[1], "weather", 1, dim)
    assert rows(streaming.fact_of(log)) == rebuilt(late, w) != rebuilt(late, w[:2])


def test_an_event_that_loses_its_label_leaves_the_fact(spark, tmp_path):
    shared = {"airline_name": "Delta Air Lines", "airline_iata": "DL", "airline_icao": "DAL", "flight_number": "9", "flight_iata": "DL9", "flight_icao": "DAL9"}
    first = [(key(0), {"data": [flight(iata="AA1")]})]
    again = [(key(200), {"data": [flight(iata="AA1", codeshared=shared)]})]
    dim, log = airports(spark), sources.CommitLog(spark, str(tmp_path / "t"))
    flights, weather = staged(spark, first, [("raw/weather/a/SFO_1.json", reading(epoch(2026, 9, 14, 19)))])
    streaming.open_fact(log, flights, weather, dim)
    assert streaming.refresh_batch(log, "flights", plans.stage_flights(documents(spark, again)), "f", 0, dim)
    want = plans.build_fact(plans.stage_flights(documents(spark, first + again)), weather, dim)
    rows = lambda df: sorted(map(str, df.select(*plans.FACT_COLUMNS).collect()))
    assert rows(streaming.fact_of(log)) == rows(want) and streaming.fact_of(log).count() == 1


def test_changed_events_are_redone_in_one_shuffle(spark, tmp_path):
    """F5. Late rows without a departure, and two departures within the millisecond that a key names: the kept-up fact equals a rebuild."""
    def landed(n, pull, dep, act):
        return key(n + 100 * pull), {"data": [flight(iata=f"AA{n}", dep_sched=dep, arr_act=act)]}

    at = ["2026-09-14T10:00:00", "2026-09-14T10:00:00.000100", "2026-09-14T10:00:00.000200", None]
    first = [landed(1, i, t, "2026-09-14T13:00:00") for i, t in enumerate(at)] + [landed(2, 5, None, "2026-09-14T13:10:00"), landed(3, 6, at[0], None)]
    late = [[landed(1, 7, at[1], "2026-09-14T14:00:00")], [landed(2, 8, None, "2026-09-14T15:00:00")]]
    dim, log = airports(spark), sources.CommitLog(spark, str(tmp_path / "t"))
    flights, weather = staged(spark, first, [("raw/weather/a/SFO_1.json", reading(epoch(2026, 9, 14, 19)))])
    streaming.open_fact(log, flights, weather, dim)
    rows = lambda df: sorted(map(str, df.select(*plans.FACT_COLUMNS).collect()))
    for i, batch in enumerate(late):
        assert streaming.refresh_batch(log, "flights", plans.stage_flights(documents(spark, batch)), "f", i, dim)
        want = plans.build_fact(plans.stage_flights(documents(spark, first + [x for b in late[:i + 1] for x in b])), weather, dim)
        assert rows(streaming.fact_of(log)) == rows(want)
        assert len(rows(want)) == 6
    marked = flights.withColumn("_late", F.lit(True))
    plan = refresh_module._changed_events(marked.where("departure_scheduled_local is not null"), dim, DEFAULTS)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("hashpartitioning(_moment")[0]
    assert above.count("Window") > 2 and above.count("Exchange") == 1 and "Join" not in above
    assert streaming.fold_fact(log) and "Exchange" not in streaming.fact_of(log)._jdf.queryExecution().executedPlan().toString()


def folded(rows, hours=6):
    """The throttle as a plain loop over each key's results in order."""
    by, out = {}, []
    for k, t, d in rows:
        by.setdefault(k, []).append((t, d))
    for k, results in by.items():
        signature = last = None
        held = 0
        for t, d in sorted(results, key=lambda x: (x[0] is not None, x[0] or T0, x[1] is not None, (x[1] or "").encode())):
            now = None if d is None else re.sub(r"\d+(\.\d+)?h\b", "Nh", d)
            if now is None:
                if signature is not None:
                    out.append((k, "recovered", t, None, held))
                signature, last, held = None, None, 0
            elif now == signature and t is not None and last is not None and t <= last + timedelta(hours=hours):
                held += 1
            else:
                out.append((k, "alert", t, d, held))
                signature, last, held = now, t, 0
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


def results(seed, keys, n):
    rng, rows = random.Random(seed), []
    for k in keys:
        t, now = T0, None
        for _ in range(n if k == "hot" else 60):
            t += timedelta(minutes=rng.choice([0, 1, 7, 30, 90, 800] if k == "hot" else [0, 0, 1, 5, 61, 400]))
            if rng.random() < (0.01 if k == "hot" else 0.2):
                now = rng.choice([None, "down", "stale"])
            rows.append((k, t, f"stale for {rng.randint(1, 9)}h" if now == "stale" else now))
    return rows


@pytest.mark.parametrize("block", [1, 16])
def test_throttle_equals_a_plain_loop(spark, monkeypatch, block):
    monkeypatch.setattr(throttle_module, "BLOCK", block)
    rows = results(3, ["a", None, "hot"], 1500) + [("a", None, "down"), ("a", None, None), ("z", None, "down"), ("z", None, None)]
    rows += rows[:40]
    got = plans.throttle_alerts(spark.createDataFrame(rows, RESULT).repartition(5)).collect()
    assert in_order(got) == in_order(folded(rows))
    assert plans.throttle_alerts(spark.createDataFrame([], RESULT)).collect() == []


@pytest.mark.parametrize("fold", [0, 40])
def test_throttle_does_not_depend_on_how_runs_are_worked_off(spark, monkeypatch, fold):
    """F24. As arrays, by blocks, or some runs each way: the same announcements."""
    monkeypatch.setattr(throttle_module, "FOLD", fold)
    rows = results(3, ["a", None, "hot"], 700) + [("a", None, "down")]
    assert in_order(plans.throttle_alerts(spark.createDataFrame(rows, RESULT).repartition(5)).collect()) == in_order(folded(rows))


def test_groups_of_the_throttle_are_spread_whatever_their_bytes(spark):
    """F24. Short runs start no Python group; groups of long runs are dealt into a fixed number of tasks, which Spark does not merge."""
    cells = spark.createDataFrame([], "k struct<key: string>, run string, ru bigint, u bigint, c bigint, d string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan(throttle_module._folded(cells, 1000))
    blocks = plan(throttle_module._by_blocks(cells, 1000, 16))
    groups, dealt = blocks.count("FlatMapGroupsInArrow"), blocks.count("REPARTITION_BY_NUM")
    assert groups == dealt == 3


def test_throttle_state_carries_over_batches(spark, tmp_path):
    rows = sorted(results(5, ["a", "b", "hot"], 300), key=lambda r: r[1])
    log = sources.CommitLog(spark, str(tmp_path / "t"))
    cuts = [0, 40, 300, len(rows)]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        # results of one time stay in one batch, as a batch in time order has them
        part = [r for r in rows if (low == 0 or r[1] > rows[low - 1][1]) and r[1] <= rows[high - 1][1]]
        assert streaming.throttle_batch(log, spark.createDataFrame(part, RESULT), "l", i)
    assert in_order(log.snapshot().read("alerts").collect()) == in_order(folded(rows))


@pytest.mark.parametrize("cuts", [[0, 7], [0, 2, 3, 5, 7]])
def test_silence_does_not_depend_on_batches(spark, tmp_path, monkeypatch, cuts):
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    hour = timedelta(hours=1)
    rows = [("a", T0), ("b", T0 + hour), ("a", T0 + 2 * hour), ("b", T0 + 2 * hour), ("b", T0 + 9 * hour), ("a", T0 + 10 * hour), ("new", T0 + 12 * hour)]
    expected = spark.createDataFrame([(k, T0 - hour) for k in ("a", "b", "never")], "member STRING, since TIMESTAMP")
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for i, (low, high) in enumerate([*zip(cuts, cuts[1:]), (7, 8)]):
            part = (rows + [(None, T0 + 100 * hour)])[low:high]
            spark.createDataFrame(part, "member STRING, at TIMESTAMP").coalesce(1).write.parquet(f"{tmp_path}/land/{i}")
            said = streaming.watch_silence(spark.readStream.schema("member STRING, at TIMESTAMP").parquet(f"{tmp_path}/land/*"), expected, "member", "at", "since", 4, "1 hour")
            (said.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out")
             .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set(store, before)
    got = {(r.member, r.kind, (r.at - T0) / hour) for r in spark.read.parquet(f"{tmp_path}/out").where("member is not null").collect()}
    assert got == {("a", "silent", 6), ("a", "recovered", 10), ("a", "silent", 14), ("b", "silent", 6), ("b", "recovered", 9), ("b", "silent", 13),
                   ("never", "silent", 3), ("new", "silent", 16)}
