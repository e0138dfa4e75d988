"""Streams, alerts, budgets: jobs that run over time."""

from datetime import datetime, timedelta
from hashlib import md5

from landing_files import airports, documents, flight, reading, write
from pyspark.sql import functions as F
from test_fact import epoch, key

from punctua import plans, sources, streaming
from punctua.session import shared_dir

T0 = datetime(2026, 9, 1)
HOUR = timedelta(hours=1)
RESULTS = [  # (hours since start, detail)
    (0, None), (1, "stale for 3h"), (2, "stale for 4.5h"), (3, "down"), (4, "down"), (9, "down"), (9.5, "down"), (10, None),
    (11, None), (12, "down"), (18, "down"), (18.1, "down")]
ALERTS = [(1, "alert", "stale for 3h", 0), (3, "alert", "down", 1), (9.5, "alert", "down", 2), (10, "recovered", None, 0),
          (12, "alert", "down", 0), (18.1, "alert", "down", 1)]


def expected():
    return [(k, T0 + h * HOUR, d, n) for h, k, d, n in ALERTS]


def test_throttle_in_batch_and_stream_agree(spark, tmp_path):
    rows = [("flights", T0 + h * HOUR, d) for h, d in RESULTS]
    schema = "check STRING, checked_at TIMESTAMP_NTZ, detail STRING"
    got = plans.throttle_alerts(spark.createDataFrame(rows[::-1], schema)).orderBy("checked_at").collect()
    assert [(r.kind, r.checked_at, r.detail, r.suppressed) for r in got] == expected()
    drop, log = tmp_path / "results", sources.CommitLog(spark, str(tmp_path / "log"))
    for i, part in enumerate((rows[:4], rows[4:9], rows[9:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{drop}/batch_id={i}")
        stream = spark.readStream.schema(schema).parquet(f"{drop}/*")
        streaming.start_throttle(stream, log, "results", str(tmp_path / "cp")).awaitTermination()
    assert not streaming.throttle_batch(log, spark.createDataFrame(rows[9:], schema), "results", 2)  # a replay
    out = log.snapshot().read("alerts").orderBy("checked_at").collect()
    assert [(r.kind, r.checked_at, r.detail, r.suppressed) for r in out] == expected()


def test_an_alert_is_due_strictly_after_the_interval(spark):
    six = 6 * HOUR
    rows = [("x", T0, "x"), ("x", T0 + six, "x"), ("x", T0 + six + timedelta(seconds=1), "x")]
    got = plans.throttle_alerts(spark.createDataFrame(rows, "check STRING, checked_at TIMESTAMP_NTZ, detail STRING")).orderBy("checked_at").collect()
    assert [(r.checked_at, r.suppressed) for r in got] == [(T0, 0), (T0 + six + timedelta(seconds=1), 1)]


def test_stream_load_takes_each_file_once_and_equals_the_batch(spark, tmp_path):
    land, table, cp = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "cp")
    for n in range(2):
        write(land, key(n), {"data": [flight(iata=f"AA{n}")]})
        streaming.start_load(streaming.read_landing_stream(spark, str(land)), table, cp).awaitTermination()
    write(land, key(9), "<html>")
    streaming.start_load(streaming.read_landing_stream(spark, str(land)), table, cp).awaitTermination()
    streaming.start_load(streaming.read_landing_stream(spark, str(land)), table, cp).awaitTermination()
    loaded = spark.read.parquet(table)
    assert {(r.source_file, r.status) for r in loaded.collect()} == {
        (key(0), "LOADED"), (key(1), "LOADED"), (key(9), "LOAD_FAILED")} and loaded.count() == 3
    batch = sources.load_new_files(sources.read_landing(spark, str(land)), None)
    assert sorted(r.raw_data for r in batch.collect()) == sorted(r.raw_data for r in loaded.collect())
    # Replaying a batch writes the same folder again.
    again = batch.join(loaded.where("batch_id = 0").select("source_file"), "source_file").collect()
    streaming.write_batch(spark.createDataFrame(again, batch.schema), 0, table)
    assert spark.read.parquet(table).count() == 3


def test_every_result_counts_for_the_throttle(spark):
    schema = "check STRING, checked_at TIMESTAMP_NTZ, detail STRING"
    rows = [("a", T0, "down"), ("a", T0 + timedelta(seconds=45), None), (None, T0, "down"), (None, T0 + HOUR, "down"), (None, T0 + 2 * HOUR, None)]
    got = {(r.check, r.kind, r.checked_at, r.suppressed) for r in plans.throttle_alerts(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("a", "alert", T0, 0), ("a", "recovered", T0 + timedelta(seconds=45), 0), (None, "alert", T0, 0), (None, "recovered", T0 + 2 * HOUR, 1)}


def test_refresh_equals_a_rebuild(spark):
    def landed(n, day, arrival, pull=0):
        return key(n + 100 * pull), {"data": [flight(iata=f"AA{n}", day=f"2026-09-{day}", dep_sched=f"2026-09-{day}T10:00:00",
                                                     dep_act=f"2026-09-{day}T10:00:00", arr_sched=f"2026-09-{day}T13:00:00", arr_act=arrival)]}

    first = [landed(i, d, f"2026-09-{d}T13:00:00") for i, d in enumerate((14, 16, 18))]
    # one pulled again with an arrival two days later, one new without an arrival
    second = [landed(0, 14, "2026-09-16T12:40:00", pull=1), landed(7, 15, None)]
    w = [("raw/weather/a/SFO_1.json", reading(epoch(2026, 9, 14, 19), wind=1.0)),
         ("raw/weather/b/SFO_2.json", reading(epoch(2026, 9, 16, 19, 30), wind=2.0))]
    dim = airports(spark)

    def fact(files, readings):
        return plans.build_fact(plans.stage_flights(documents(spark, files)), plans.stage_weather(documents(spark, readings)), dim)

    before, after = fact(first, w[:1]), fact(first + second, w)
    events = after.drop(*[c for c in after.columns if c.startswith("weather_")], "has_weather_match")
    readings = plans.series_readings(plans.stage_weather(documents(spark, w)))
    late_events = fact(second, w).select("flight_event_key")
    late_readings = plans.stage_weather(documents(spark, w[1:])).select(F.col("iata_code").alias("arrival_airport"), "observed_at")
    fresh = streaming.refresh_events(before, events, readings, late_events, late_readings)
    rows = lambda df: sorted(map(str, df.select(*after.columns).collect()))
    assert fresh.count() == 4 and rows(fresh) == rows(after) != rows(before)
    assert rows(streaming.refresh_events(before, events, readings)) == rows(before)


def test_compacted_table_has_one_row_per_key(spark, tmp_path):
    order = lambda: [F.desc("v")]
    for i in range(3):
        streaming.write_batch(spark.createDataFrame([(k, i) for k in range(5 - i)], "k INT, v INT"), i, f"{tmp_path}/t")
    streaming.compact(spark, f"{tmp_path}/t", f"{tmp_path}/c", ["k"], order)
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/c").collect()) == [(0, 2), (1, 2), (2, 2), (3, 1), (4, 0)]


def test_usage_budget(spark):
    files = spark.createDataFrame([(datetime(2026, 9, d),) for d in (1, 1, 3, 5)], "at TIMESTAMP_NTZ")
    r = sources.usage_budget(files, "at", 90, 5, F.expr("TIMESTAMP_NTZ'2026-09-05 09:00:00'")).first()
    assert (r.used, r.runs_left, r.refused, r.headroom) == (4, 12, False, 90 - 4 - 5 - 60)
    assert sources.usage_budget(files, "at", 8, 5, F.expr("TIMESTAMP_NTZ'2026-09-05 09:00:00'")).first().refused


def test_carried_results(spark):
    ticks = spark.createDataFrame([("a", T0 + h * HOUR) for h in (0, 1, 3)], "check STRING, checked_at TIMESTAMP_NTZ")
    results = spark.createDataFrame([("a", T0 + HOUR, "late"), ("a", T0 + 2 * HOUR, None)],
                                    "check STRING, checked_at TIMESTAMP_NTZ, detail STRING")
    got = plans.carry_result(ticks, results).orderBy("checked_at").collect()
    assert [(r.detail, r.result_at) for r in got] == [(None, None), ("late", T0 + HOUR), (None, T0 + 2 * HOUR)]


def test_checkpoint_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark, "x").startswith(f"{root.rstrip('/')}/x-" if root else "/")


def test_late_rows_repair_their_hour_and_a_replayed_batch_changes_nothing(spark, tmp_path):
    at = lambda h, m=0: datetime(2026, 9, 1, h, m)
    drops = [[(at(10), "a"), (at(12), "a"), (None, "a")], [(at(10, 30), "a"), (at(11), "b"), (at(13), None)], [(at(12, 59), "b"), (at(10), "a")]]
    table, checkpoint = str(tmp_path / "hours"), str(tmp_path / "checkpoint")
    for i, rows in enumerate(drops):
        streaming.write_batch(spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, k STRING"), i, str(tmp_path / "landing"))
        stream = spark.readStream.schema("ts TIMESTAMP_NTZ, k STRING").parquet(f"{tmp_path}/landing/*")
        streaming.start_hours(stream, table, checkpoint, "ts", ["k"], F.expr("INTERVAL 1 HOUR")).awaitTermination()
    read = lambda: sorted(((r.hour.hour, r.k or "", r.rows, r.newest.hour * 60 + r.newest.minute, r.late)
                           for r in streaming.read_hours(spark, table, ["k"]).collect()))
    want = [(10, "a", 3, 630, 2), (11, "b", 1, 660, 0), (12, "a", 1, 720, 0), (12, "b", 1, 779, 0), (13, "", 1, 780, 0)]
    assert read() == want
    last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # as if the job had died between the write and the commit
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    stream = spark.readStream.schema("ts TIMESTAMP_NTZ, k STRING").parquet(f"{tmp_path}/landing/*")
    streaming.start_hours(stream, table, checkpoint, "ts", ["k"], F.expr("INTERVAL 1 HOUR")).awaitTermination()
    assert read() == want


def test_a_table_is_published_only_if_the_checks_seen_by_the_write_pass(spark, tmp_path):
    log = sources.CommitLog(spark, str(tmp_path / "log"))
    checks = [plans.ScanCheck("no_gap", "t", lambda: F.count_if(F.col("v").isNull())),
              plans.ScanCheck("small", "t", lambda: F.count_if(F.col("v") > 5), "warn"), plans.ScanCheck("other", "u", lambda: F.count_if(F.lit(True)))]
    good, bad = spark.createDataFrame([(1,), (9,)], "v INT"), spark.createDataFrame([(1,), (None,)], "v INT")
    for df, outcome, published in ((good, [("no_gap", 0, True), ("small", 1, False)], True), (bad, [("no_gap", 1, False), ("small", 0, True)], False),
                                   (good.limit(0), [("no_gap", 0, True), ("small", 0, True)], True)):
        rows, done = plans.publish_checked(log, df, "t", checks)
        assert sorted((r.check, r.violations, r.passed) for r in rows.collect()) == outcome and done is published
        if df is bad:
            assert sorted(r.v for r in log.snapshot().read("t").collect()) == [1, 9]
    assert log.snapshot().read("t").count() == 0


def test_fingerprint_can_be_computed_elsewhere(spark):
    keys = ["a", "b", "b", None]
    hashes = [int(md5(k.encode()).hexdigest()[:15], 16) for k in keys if k]
    got = sources.fingerprint(spark.createDataFrame([(k,) for k in keys], "k STRING").repartition(3), "k", {}).first()
    assert (got.row_count, got.key_count, got.key_xor, got.key_sum) == (4, 3, hashes[0], str(sum(hashes)))
