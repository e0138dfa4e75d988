from datetime import datetime, timezone

import pytest
from landing_files import airports, documents, flight, reading, write
from pyspark.sql import functions as F

from punctua import plans, sources
from punctua.config import DEFAULTS


def epoch(*at):
    return int(datetime(*at, tzinfo=timezone.utc).timestamp())


def key(n, place="SFO", day="2026-09-17"):
    return f"raw/flights/{day}/{place}_0900{n:02d}_{n:06d}.json"


def fact_of(spark, records, readings=(), **kw):
    raw = documents(spark, [(key(i), {"data": [r]}) for i, r in enumerate(records)])
    weather = documents(spark, [(f"raw/weather/2026-09-16/{p}_{i:06d}_1.json", b) for i, (p, b) in enumerate(
        readings or [("SFO", reading(epoch(2026, 9, 16, 19)))])])
    return plans.build_fact(plans.stage_flights(raw), plans.stage_weather(weather), airports(spark), **kw)


SHARED = {"airline_name": "delta air lines", "airline_iata": "dl", "flight_iata": "dl1589"}


def test_five_labels_pulled_twice_are_one_flight_with_five_labels(spark):
    labels = [flight(iata="DL1589", airline=("Delta Air Lines", "DL", "DAL"))] + [
        flight(iata=f"XX{i}", airline=("Other", "XX", "XXX"), codeshared=SHARED) for i in range(4)]
    rows = fact_of(spark, labels + labels).collect()
    assert len(rows) == 1
    assert (rows[0].marketing_label_count, rows[0].operating_flight_iata, rows[0].operating_carrier_code) == (5, "DL1589", "DL")
    assert rows[0].flight_event_key == "DL1589_2026-09-16 10:00:00.000" and rows[0].has_codeshare_partners


def test_the_newest_pull_of_a_label_wins(spark):
    rows = fact_of(spark, [flight(arr_act=None), flight(arr_act="2026-09-16T13:30:00"), flight(arr_act="2026-09-16T13:10:00")]).collect()
    assert [r.arrival_delay_minutes for r in rows] == [30]


def test_unidentified_records(spark):
    nothing = flight(iata=None, icao=None, airline=("empty", None, None))
    marked = flight(iata="XN", icao="XAR", airline=("empty", None, None))
    rows = fact_of(spark, [nothing, marked]).collect()
    assert [(r.operating_flight_iata, r.operating_carrier_name, r.operating_carrier_code) for r in rows] == [("XN", "Unknown", "XN")]


def test_scope_follows_the_dimension(spark):
    assert fact_of(spark, [flight(arr="JFK")]).count() == 0


def _times(dep, arr):
    """Records that left and landed the given minutes off schedule."""
    f = lambda base, m: datetime.fromtimestamp(base + m * 60, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    d, a = epoch(2026, 9, 16, 10), epoch(2026, 9, 16, 13)
    return {"dep_act": f(d, dep), "arr_act": f(a, arr)}


FLAG_CASES = [  # departure delay, arrival delay -> suspect, retimed, late
    (333, 0, True, True, False), (-330, -20, True, False, False), (-180, -20, False, False, False),
    (0, -195, False, False, False), (0, 240, False, False, True), (0, 241, True, False, True),
    (60, 1, False, True, False), (59, 1, False, False, False), (20, 15, False, False, True), (20, 14, False, False, False)]


def test_flags(spark):
    fact = fact_of(spark, [flight(iata=f"AA{i}", **_times(c[0], c[1])) for i, c in enumerate(FLAG_CASES)])
    got = {r.operating_flight_iata: r for r in fact.collect()}
    for i, (dep, arr, suspect, retimed, late) in enumerate(FLAG_CASES):
        r = got[f"AA{i}"]
        assert (r.departure_delay_minutes, r.arrival_delay_minutes, r.minutes_recovered) == (dep, arr, dep - arr)
        assert (r.has_suspect_times, r.has_retimed_arrival_schedule, r.is_delayed_arrival) == (suspect, retimed, late)


def test_a_missing_origin_zone_still_judges_by_delays(spark):
    r = fact_of(spark, [flight(dep_zone=None, **_times(266, 0))]).first()
    assert r.has_suspect_times and r.departure_actual_utc is None and r.departure_delay_minutes == 266


def test_ambiguous_hour_is_suspect_and_has_no_utc(spark):
    r = fact_of(spark, [flight(arr_sched="2026-11-01T00:50:00", arr_act="2026-11-01T01:30:00",
                               dep_sched="2026-10-31T20:00:00", dep_act="2026-10-31T20:05:00")]).first()
    assert r.arrival_actual_utc is None and r.has_dst_ambiguous_time and r.has_suspect_times
    assert r.arrival_delay_minutes == 40 and not r.has_weather_match


LAG_CASES = {  # one airport each: reading at -> lag, match
    "SFO": ((2026, 9, 16, 20, 5, 0), 0, True), "LAX": ((2026, 9, 16, 18, 5, 59), 120, True),
    "ATL": ((2026, 9, 16, 18, 4, 59), 121, False), "MIA": ((2026, 9, 16, 20, 5, 1), None, False),
    "EWR": ((2026, 8, 1, 0, 0, 0), 67445, False)}


def test_readings_match_by_boundary_minutes_and_the_lag_stays(spark):
    fact = fact_of(spark, [flight(iata=p, arr=p) for p in LAG_CASES],
                   [(p, reading(epoch(*c[0]), wind=9.5)) for p, c in LAG_CASES.items()])
    got = {r.arrival_airport: (r.weather_lag_minutes, r.has_weather_match, r.weather_wind_speed) for r in fact.collect()}
    assert got == {p: (lag, match, 9.5 if match else None) for p, (_, lag, match) in LAG_CASES.items()}


def test_reading_at_the_scheduled_time(spark):
    readings = [("SFO", reading(epoch(2026, 9, 16, 19, 59), wind=5.0)), ("SFO", reading(epoch(2026, 9, 16, 20, 4), wind=1.0))]
    r = fact_of(spark, [flight()], readings, at_schedule=True).first()
    assert (r.weather_wind_speed, r.wind_at_schedule) == (1.0, 5.0)


def test_columns(spark):
    fact = fact_of(spark, [flight()])
    assert tuple(fact.columns) == plans.FACT_COLUMNS and len(fact.columns) == 43
    assert dict(fact.dtypes)["source_departure_delay_minutes"] == "decimal(38,0)"


def test_row_order_does_not_matter(spark):
    records = [flight(iata=f"AA{i % 4}", arr_act=f"2026-09-16T13:{i:02d}:00") for i in range(12)]
    print_of = lambda rs: sources.fingerprint(fact_of(spark, rs), "flight_event_key", {
        "delay": F.sum("arrival_delay_minutes")}).first()
    assert print_of(records) == print_of(records[::-1])


def test_staging_details(spark):
    raw = documents(spark, [(key(1), {"data": []}), (key(2), {"error": {"code": "x"}}), (key(3), {"data": [
        flight(codeshared=None), flight(delays=("12.7", "n/a"))]})])
    rows = plans.stage_flights(raw).collect()
    assert len(rows) == 2 and len(rows[0].asDict()) == 29
    assert [r.codeshare_flight_iata for r in rows] == [None, None]
    assert (int(rows[1].source_departure_delay_minutes), rows[1].source_arrival_delay_minutes) == (13, None)
    docs = [("raw/weather/2026-09-04/203000.json", reading(1790000000, weather=[])),
            ("raw/weather/2026-09-04/ATL_203000_1.json", reading(1790000000, gust=12.5))]
    w = {r.source_file[-6:-5]: r for r in plans.stage_weather(documents(spark, docs)).collect()}
    assert (w["0"].iata_code, w["0"].weather_main, w["1"].iata_code, w["1"].wind_gust) == (None, None, "ATL", 12.5)


def test_quality_suite_counts_and_gates(spark):
    raw = documents(spark, [(key(1), {"data": [flight(), flight(iata="AA2", status="active")]})])
    weather = documents(spark, [(f"raw/weather/2026-09-16/{p}_190000_1.json", reading(epoch(2026, 9, 16, 19))) for p in ("SFO", "ZZZ")])
    tables = {"raw_flights": raw, "stg_flights": plans.stage_flights(raw), "stg_weather": plans.stage_weather(weather),
              "dim_airports": airports(spark)}
    tables["fact"] = plans.build_fact(tables["stg_flights"], tables["stg_weather"], tables["dim_airports"])
    checks = plans.all_checks()
    assert len(checks) == 48 and sum(c.severity == "warn" for c in checks) == 3
    found = {r.check: r.violations for r in plans.run_checks(tables, checks).collect()}
    assert len(found) == 48
    bad = {k: v for k, v in found.items() if v}
    assert bad == {"accepted_values_stg_flights_flight_status": 1, "relationships_stg_weather_iata_code": 1,
                   "weather_fresh_per_airport": 4}
    with pytest.raises(plans.ChecksFailed):
        plans.build_gated(tables, lambda t: pytest.fail("the fact must not be built"))
    plans.gate(plans.run_checks(tables, [c for c in checks if c.severity == "warn"]))


def test_freshness_problems(spark):
    cfg = DEFAULTS
    raw = documents(spark, [(key(1, "SFO"), {"data": [flight()]}), (key(2, "MIA"), {"data": []})])
    flights = plans.stage_flights(raw)
    weather = plans.stage_weather(documents(spark, [(f"raw/weather/x/{p}_1.json", reading(epoch(2026, 9, 17, h))) for p, h in (
        ("SFO", 9), ("MIA", 2), ("ATL", 9), ("EWR", 9))]))
    fact = plans.build_fact(flights, weather, airports(spark))
    as_of = F.expr("TIMESTAMP_NTZ'2026-09-17 10:00:00'")
    got = {(r.source, r.member): r.detail for r in plans.freshness_problems(airports(spark), weather, flights, fact, as_of, cfg).collect()}
    assert got[("weather", "MIA")] == "weather stale for MIA (8.0h)" and got[("weather", "LAX")].endswith("(no data)")
    assert ("weather", None) not in got and ("flights", "MIA") in got and ("flights", "SFO") not in got
    late = {(r.source, r.member) for r in plans.freshness_problems(
        airports(spark), weather, flights.where("false"), fact, F.expr("TIMESTAMP_NTZ'2026-09-30 10:00:00'"), cfg).collect()}
    assert late == {("weather", None), ("flights", None)}


def test_landing_to_published_fact(spark, tmp_path):
    write(tmp_path, key(1), {"data": [flight()]})
    write(tmp_path, "raw/flights/2026-09-17/note.txt", "ignored")
    raw = sources.read_landing(spark, str(tmp_path))
    assert [r.source_file for r in raw.collect()] == [key(1)]
    sources.publish(plans.stage_flights(raw), str(tmp_path / "wh"), "stg_flights", "ci")
    sources.publish(plans.stage_flights(raw).limit(0), str(tmp_path / "wh"), "stg_flights", "ci")
    assert sources.read_published(spark, str(tmp_path / "wh"), "stg_flights", "ci").count() == 0
    assert not sources.drop_namespace(spark, str(tmp_path / "wh"), "main") and sources.drop_namespace(spark, str(tmp_path / "wh"), "ci")
    assert not (tmp_path / "wh" / "ci").exists()


def test_payload_classes(spark):
    bodies = ['{"data": [{"a": null}]}', '{"data": []}', '{"error": {"code": 1}, "data": []}', '{"x": 1}', "<html>", '{"data": 3}']
    got = [r.c for r in documents(spark, [(str(i), b) for i, b in enumerate(bodies)]).select(
        sources.payload_class("raw_data").alias("c")).collect()]
    assert got == ["accepted", "empty", "rejected", "rejected", "rejected", "rejected"]


def test_loads_are_idempotent_and_independent(spark):
    landed = documents(spark, [("a", "{}"), ("b", "<html>"), ("a", "{}")])
    first = sources.load_new_files(landed, None)
    assert {(r.status, r.files) for r in sources.load_report(first).collect()} == {("LOADED", 1), ("LOAD_FAILED", 1)}
    assert sources.load_new_files(landed, first).count() == 0
    ran = []
    with pytest.raises(RuntimeError, match="one"):
        sources.run_loads({"one": lambda: 1 / 0, "two": lambda: ran.append(2)})
    assert ran == [2]


def test_export_fallback_only_for_a_missing_table(spark, tmp_path):
    (tmp_path / "x.csv").write_text("FLIGHT_DATE,OBSERVED_AT\n2026-09-16,2026-09-16 10:00:00\n")
    schema = "FLIGHT_DATE STRING, OBSERVED_AT STRING"
    with pytest.warns(UserWarning, match="export"):
        df = sources.read_table_or_export(spark, lambda: spark.read.parquet(str(tmp_path / "none")), str(tmp_path / "x.csv"), schema)
    assert df.first().observed_at == datetime(2026, 9, 16, 10)
    with pytest.raises(Exception, match="COLUMN"):
        sources.read_table_or_export(spark, lambda: spark.range(1).select("nope"), str(tmp_path / "x.csv"), schema)


def test_parsed_bodies_stage_like_text(spark, tmp_path):
    write(tmp_path, "raw/flights/2026-09-16/SFO_1.json", {"data": [
        flight(), flight(iata=None, delays=(7, "x")), 3, None, {"flight": 5, "airline": [1], "new": {"deep": 1}}]})
    write(tmp_path, "raw/flights/2026-09-16/SFO_2.json", '{"data": [')
    write(tmp_path, "raw/flights/2026-09-16/SFO_3.json", {"data": []})
    write(tmp_path, "raw/flights/2026-09-16/SFO_4.json", "")
    docs, raw = sources.read_documents(spark, str(tmp_path)), sources.read_landing(spark, str(tmp_path))
    assert sorted(map(str, plans.stage_flights(docs).collect())) == sorted(map(str, plans.stage_flights(raw).collect()))
    classes = lambda df: sorted((r.source_file, r.payload_class) for r in df.select("source_file", "payload_class").collect())
    assert classes(sources.classify_documents(docs)) == classes(sources.classify_payload(raw))
    docs.write.parquet(str(tmp_path / "table"))
    fields = {(r.field, r.type): r.records for r in plans.field_profile(plans.flatten_documents(spark.read.parquet(str(tmp_path / "table")))).collect()}
    assert fields[("new.deep", "BIGINT")] == 1 and fields[("airline", "OBJECT")] == 2 and fields[("airline", "ARRAY")] == 1
    assert fields[("flight.iata", "VOID")] == 1 and ("flight.iata", "BIGINT") not in fields
    weather = documents(spark, [("raw/weather/2026-09-16/SFO_1.json", reading(1789500000)), ("raw/weather/2026-09-16/LAX_1.json", reading(1789500000, temp="x", weather=5)),
                                ("raw/weather/x.json", "x")])
    assert plans.stage_weather(sources.parse_documents(weather)).collect() == plans.stage_weather(weather).collect()
