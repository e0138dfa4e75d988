"""What is shuffled and written on the way to documents and events: narrow rows, once."""

import datetime as dt
import glob
import gzip
import json
import re

from pyspark.sql import functions as F

from punctua.catalog import core, derived, reporting
from punctua.catalog.registry import Tables
from punctua.plans.fact import event_rows, physical_events


def _star(spark, root, keys):
    """A small star schema; ``keys`` are (order, line, supplier) of the line items."""
    day = "TIMESTAMP_NTZ'1995-03-01 00:00:00'"
    tables = {
        "region": spark.createDataFrame([(0, "AFRICA")], "r_regionkey INT, r_name STRING"),
        "nation": spark.createDataFrame([(0, 0)], "n_nationkey INT, n_regionkey INT"),
        "customer": spark.createDataFrame([(1, 0, "BUILDING")], "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING"),
        "orders": spark.createDataFrame([(k, 1, 100.0 + k, "1-URGENT") for k in sorted({o for o, _, _ in keys})],
                                        "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING").withColumn("o_orderdate", F.expr(day)),
        "lineitem": spark.createDataFrame([(o, n, 10 * o + n, s, 20.0, 0.01, 0.02, "R", "O") for o, n, s in keys],
                                          "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
                                          " l_returnflag STRING, l_linestatus STRING").withColumn("l_shipdate", F.expr(day)),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return Tables(spark, str(root))


def test_landed_files_are_whole_and_compressed(spark, tmp_path, monkeypatch):
    """F1, F2. One file an aircraft with all its records, a row without an aircraft included."""
    keys = [(o, n, [1, 2, 2, None][(o + n) % 4]) for o in range(1, 9) for n in (1, 2, 3)]
    t = _star(spark, tmp_path / "in", keys)
    at = {}
    real = derived.landing_folder
    monkeypatch.setattr(derived, "landing_folder", lambda t, name, write: at.setdefault(name, real(t, name, write)))
    back = core._landed_by_aircraft(t)
    files = glob.glob(f"{at['raw-by-aircraft'].removeprefix('file:')}/aircraft=*/*.txt.gz")
    bodies = {re.search("aircraft=([^/]+)/", f)[1]: json.loads(gzip.open(f, "rt").read())["data"] for f in files}
    expected = {}
    for o, n, s in keys:
        expected.setdefault("__HIVE_DEFAULT_PARTITION__" if s is None else f"hex{s}", []).append(f"OP{o}" if n == 1 else f"L{n}X{o}")
    assert {k: sorted(r["flight"]["iata"] for r in v) for k, v in bodies.items()} == {k: sorted(v) for k, v in expected.items()}
    assert len(files) == len(expected)
    assert core.landing_documents(t).count() == len(keys)
    assert {r.source_file for r in back.select("source_file").collect()} == set(expected)


def test_lines_are_shuffled_before_documents_are_built(spark, tmp_path):
    """F1, F2, F7. No exchange carries a document, and line items are dealt by the key they join on, not row by row."""
    t = _star(spark, tmp_path / "in", [(o, n, 1) for o in (1, 2) for n in (1, 2)])
    for df in (derived.raw_flights(t), derived.raw_flights_by_aircraft(t)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan
        below = plan[min(m.start() for m in re.finditer("Exchange hash", plan)):]
        assert "StructsToJson" in plan and "StructsToJson" not in below


_LABEL = ("marketing_flight_iata STRING, operating_flight_iata STRING, departure_scheduled_local TIMESTAMP_NTZ, arrival_actual_local TIMESTAMP_NTZ,"
          " source_file STRING, note STRING")


def test_events_are_collapsed_in_one_shuffle(spark):
    """F4-F6, F8-F19. Same events as by hand, rows without a departure included; rows with one meet in one shuffle."""
    at = [None, dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9)]
    rows = [(f"M{i % 5}" if i % 11 else None, f"O{i % 3}", at[i % 4 % 3], None if i % 7 == 0 else dt.datetime(2024, 1, 1, 12, i), f"f{i:03}", f"n{i}") for i in range(60)]
    newest = {}
    for r in rows:  # the newest label by arrival (unknown last), then by file
        key = (r[0], r[2])
        rank = (r[3] is not None, r[3] or dt.datetime.min, r[4])
        if key not in newest or rank > newest[key][0]:
            newest[key] = (rank, r)
    events = {}
    for _, r in newest.values():
        events.setdefault((r[1], r[2]), []).append(r)
    expected = {k: (min(v, key=lambda r: (r[0] is None, r[0] or ""))[5], len(v)) for k, v in events.items()}
    made = physical_events(spark.createDataFrame(rows, _LABEL))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert {(r.operating_flight_iata, r.departure_scheduled_local): (r.note, r.marketing_label_count) for r in made.collect()} == expected
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+, \d+\)", plan) == ["departure_scheduled_local"]
    assert plan.count("Exchange hash") == 3  # two more for rows without a departure


def test_events_carry_only_what_the_fact_takes(spark):
    """F4-F6, F8-F19. File names and raw designators stay behind."""
    from punctua.plans import stage_flights
    staged = stage_flights(spark.createDataFrame([("{}", "raw/flights/2024-01-01/MIA_000000_x.json")], "raw_data STRING, source_file STRING"))
    made = event_rows(staged, spark.createDataFrame([("MIA",)], "iata_code STRING"))
    assert not {"source_file", "airline_name", "flight_icao", "codeshare_flight_iata", "flight_status"} & set(made.columns)


def test_checked_tables_are_written_once(spark, tmp_path, monkeypatch):
    """F6. What is published is the table that later steps read, also where a check failed; a table written before is left alone."""
    t = _star(spark, tmp_path / "in", [(o, n, 1 + o % 2) for o in range(1, 6) for n in (1, 2, 3)])
    spark.createDataFrame([(1, "S1", 0), (2, "S2", 0)], "s_suppkey BIGINT, s_name STRING, s_nationkey INT").write.parquet(f"{t.folder}/supplier.parquet")
    again = t.lineitem.where("l_orderkey = 1 and l_linenumber = 1").withColumn("l_quantity", F.lit(50.0)).collect()  # pulled again before it landed
    spark.createDataFrame(again, t.lineitem.schema).write.mode("append").parquet(f"{t.folder}/lineitem.parquet")
    monkeypatch.setattr(derived, "_built", {})
    outcomes = reporting.checked_publish(t).collect()
    assert {r.table: r.published for r in outcomes} == {"stg_flights": False, "stg_weather": True, "fact": True}
    at = {name: path for (_, _, name), path in derived._built.items()}
    assert all(f"/{name}/part-" in at[name] and "/checked-" in at[name] for name in ("stg_flights", "stg_weather", "fact"))
    assert sorted(reporting.checked_publish(t).collect()) == sorted(outcomes)
    assert {name: path for (_, _, name), path in derived._built.items()} == at
    built = derived.fact(t, at_schedule=True)
    assert sorted(map(str, derived.fact_table(t).collect())) == sorted(map(str, built.collect())) and built.count() == 5


def test_names_are_cleaned_once_an_event(spark):
    """F11-F17. Title case is worked out behind the shuffle of the labels, for the one that an event keeps."""
    from punctua.plans import stage_flights
    record = {"flight_status": "landed", "departure": {"scheduled": "2024-01-01T08:00:00+00:00"}, "arrival": {"iata": "MIA", "actual": "2024-01-01T12:00:00+00:00"}}
    records = [{**record, "airline": {"name": name}, "flight": {"iata": label, "codeshared": shared}} for name, label, shared in (
        ("delta air (oneworld)", "DL1", None), ("EMPTY", "AF2", {"airline_name": "DELTA AIR", "flight_iata": "dl1"}), (None, "KL3", {"airline_name": "empty", "flight_iata": "kl9"}))]
    raw = spark.createDataFrame([(json.dumps({"data": records}), "raw/flights/2024-01-01/MIA_000000_x.json")], "raw_data STRING, source_file STRING")
    made = event_rows(stage_flights(raw), spark.createDataFrame([("MIA",)], "iata_code STRING"))
    depth = {x: [re.search("[A-Z]", line).start() for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if x in line]
             for x in ("regexp_extract_all", "Exchange hash")}
    assert max(depth["regexp_extract_all"]) < min(depth["Exchange hash"])
    assert {(r.operating_flight_iata, r.operating_carrier_name, r.marketing_carrier_name, r.marketing_label_count) for r in made.collect()} == {
        ("DL1", "Delta Air", "Unknown", 2), ("KL9", "Unknown", "Unknown", 1)}


def _labels():
    """Records with and without a departure, a label pulled twice, several labels an event and an hour that comes twice."""
    at = [None, "2024-11-03T01:30:00", "2024-11-03T08:00:00"]
    return [{"flight_status": "landed", "airline": {"name": f"carrier {i % 4}"},
             "flight": {"iata": f"M{i % 5}" if i % 11 else None, "icao": f"I{i}", "codeshared": {"flight_iata": f"op{i % 3}"} if i % 2 else None},
             "departure": {"iata": "JFK", "timezone": "America/New_York" if i % 4 else None, "scheduled": at[i % 7 % 3], "actual": at[i % 5 % 3], "delay": str(i)},
             "arrival": {"iata": "MIA", "timezone": "America/New_York", "scheduled": "2024-11-03T11:00:00", "actual": f"2024-11-03T11:{i:02}:00" if i % 6 else None}}
            for i in range(60)]


def test_labels_are_read_once_and_timed_as_events(spark, tmp_path):
    """F2-F13, F19. From typed rows, read once and written half collapsed, come the same events as from staged rows; instants are converted behind the shuffle."""
    from punctua.plans import stage_flights, type_flights
    raw = spark.createDataFrame([(json.dumps({"data": [r]}), f"raw/flights/2024-11-04/MIA_{i:06}_x.json") for i, r in enumerate(_labels())], "raw_data STRING, source_file STRING")
    dim, plans = spark.createDataFrame([("MIA",)], "iata_code STRING"), []

    def tap(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        rows.write.parquet(f"{tmp_path}/events")
        return spark.read.parquet(f"{tmp_path}/events")

    staged, once = event_rows(stage_flights(raw), dim), event_rows(type_flights(raw), dim, tap=tap)
    want = sorted(map(str, staged.collect()))
    assert sorted(map(str, once.select(*staged.columns).collect())) == want
    assert sorted(map(str, event_rows(type_flights(raw), dim).select(*staged.columns).collect())) == want
    assert any("departure_scheduled_local=None" in r for r in want) and any("has_dst_ambiguous_time=True" in r for r in want)
    assert len(plans) == 1 and plans[0].count("Generate explode") == 1 and plans[0].count("Exchange hashpartitioning(departure_scheduled_local") == 1
    depth = {x: [re.search("[A-Z]", line).start() for line in plans[0].splitlines() if x in line] for x in ("convert_timezone", "Exchange hash")}
    assert max(depth["convert_timezone"]) < min(depth["Exchange hash"])


def test_a_fact_alone_needs_no_staged_tables(spark, tmp_path, monkeypatch):
    """F2-F13, F19. Reports write the collapsed events and the fact; staged tables are read where they have been written. Both give one fact."""
    t = _star(spark, tmp_path / "in", [(o, n, 1 + o % 2) for o in range(1, 6) for n in (1, 2, 3)])
    spark.createDataFrame([(1, "S1", 0), (2, "S2", 0)], "s_suppkey BIGINT, s_name STRING, s_nationkey INT").write.parquet(f"{t.folder}/supplier.parquet")
    monkeypatch.setattr(derived, "_built", {})
    alone = sorted(map(str, derived.fact_table(t).collect()))
    assert {name for _, _, name in derived._built} == {"events", "points-2", "fact"} and len(alone) == 5
    derived._built.clear()
    derived.flights_table(t), derived.weather_table(t)
    assert sorted(map(str, derived.fact_table(t).collect())) == alone


_BODIES = ['{"name":"a","main":{"temp":12.5,"humidity":55.5},"wind":{"speed":3},"dt":1700000000}', '{"name":5,"main":{"temp":"12.5","feels_like":1e2},"dt":"1700000000"}',
           '{"main":{"temp":-0,"feels_like":-0.5},"dt":1.5}', '{"main":{"temp":NaN,"feels_like":"NaN"},"dt":17000000000000000000000}', '{"main":{"temp":1e400,"humidity":1e400},"dt":5}',
           '{"main":[1],"weather":{"main":"x"},"dt":5}', '{"weather":[{"main":1},{"main":"b"}],"visibility":true}', '{"weather":[],"wind":null,"dt":1,"dt":2}', '[1]', "x", "", "{}", None]


def test_numbers_of_readings_are_those_of_their_text(spark):
    """F2-F16, F18. Plain numbers are parsed as numbers; whatever is odd gives what its text gives."""
    from punctua.plans import stage_weather
    raw = spark.createDataFrame([(b, f"raw/weather/2024-01-01/MIA_{i:06}_x.json") for i, b in enumerate(_BODIES)], "raw_data STRING, source_file STRING")
    got = {int(r.source_file[-12:-7]): r for r in stage_weather(raw).collect()}
    seen = {i: (r.station_name, r.temp_f, r.feels_like_f, r.humidity, r.wind_speed, r.weather_main, r.visibility_m, r.observed_at and int(r.observed_at.replace(tzinfo=dt.timezone.utc).timestamp()))
            for i, r in got.items()}
    assert str(seen[3][2]) == "nan"
    assert {k: v for k, v in seen.items() if k != 3} == {
        2: (None, 0.0, -0.5, None, None, None, None, None), 0: ("a", 12.5, None, 56, 3.0, None, None, 1700000000), 1: ("5", 12.5, 100.0, None, None, None, None, 1700000000), 4: (None, None, None, None, None, None, None, 5),
        5: (None, None, None, None, None, None, None, 5), 6: (None, None, None, None, None, "1", None, None), 7: (None, None, None, None, None, None, None, 2),
        **{i: (None,) * 8 for i in range(8, 13)}}
    assert seen[3][7] is None
    plan = stage_weather(raw)._jdf.queryExecution().executedPlan().toString()
    assert "StructField(temp,DoubleType" in plan


def test_readings_are_shuffled_once(spark):
    """F2-F16. Readings are deduplicated and looked up in one shuffle by place and time bucket, with the matches of a shuffle for each step."""
    from punctua.plans import series_readings, with_both_readings
    from punctua.plans.fact import WEATHER_COLUMNS
    at = dt.datetime(2024, 1, 1)
    moved = lambda m: None if m is None else at + dt.timedelta(minutes=m)
    values = list(WEATHER_COLUMNS)
    readings = spark.createDataFrame([("MIA" if i % 9 else None, moved(37 * (i % 40)) if i % 13 else None, f"f{i:03}", *["x"] * 2, *[float(i)] * 6) for i in range(120)],
                                     f"iata_code STRING, observed_at TIMESTAMP_NTZ, source_file STRING, {values[0]} STRING, {values[1]} STRING, " + ", ".join(f"{v} DOUBLE" for v in values[2:]))
    events = spark.createDataFrame([(i, "MIA" if i % 7 else "SFO", moved(i * 31 if i % 5 else None), moved(i * 31 - 45)) for i in range(60)],
                                   "n INT, arrival_airport STRING, arrival_actual_utc TIMESTAMP_NTZ, arrival_scheduled_utc TIMESTAMP_NTZ")
    want = with_both_readings(events, series_readings(readings))
    seen = []

    def tap(points):
        seen.append(points._jdf.queryExecution().executedPlan().toString())
        return points

    got = with_both_readings(events, series_readings(readings, "_bucket"), dealt="_bucket", tap=tap)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and got.where("weather_observed_at IS NOT NULL").count() > 20
    assert seen[0].count("Exchange hashpartitioning(arrival_airport") + seen[0].count("Exchange hashpartitioning(iata_code") == 3  # readings; distinct points, by bucket


def test_shuffles_are_freed_and_scratch_is_discarded(spark, tmp_path, monkeypatch):
    """F1. Builds and the kept-up fact run with shuffle files freed job by job, the setting of the session is restored, and no scratch folder is left."""
    from punctua.catalog import shared
    from punctua.streaming import refresh
    key, folders, states = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], []
    before = spark.conf.get(key)
    t = _star(spark, tmp_path / "in", [(o, n, 1 + o % 2) for o in range(1, 9) for n in (1, 2, 3)])
    spark.createDataFrame([(1, "S1", 0), (2, "S2", 0)], "s_suppkey BIGINT, s_name STRING, s_nationkey INT").write.parquet(f"{t.folder}/supplier.parquet")
    monkeypatch.setattr(derived, "_built", {})
    real = refresh.scratch

    def scratch(df, name, made=None):
        back = real(df, name, made)
        folders.append(made[-1].removeprefix("file:"))
        states.append((df.sparkSession.conf.get(key), bool(glob.glob(f"{folders[-1]}/*.parquet"))))
        return back

    monkeypatch.setattr(refresh, "scratch", scratch)
    got = shared.stream_refresh(t)
    assert len(folders) == 8 and set(states) == {("true", True)} and not any(glob.glob(f) for f in folders)
    assert spark.conf.get(key) == before
    assert sorted(r.flight_event_key for r in got.collect()) == sorted(r.flight_event_key for r in derived.fact(t).collect())


def test_records_are_landed_as_they_were_built(spark, tmp_path):
    """F17, F20. The record of a document is at hand as text, so landing it parses no document."""
    t = _star(spark, tmp_path / "in", [(o, n, 1) for o in (1, 2) for n in (1, 2)])
    rows = derived.raw_flights_by_aircraft(t).collect()
    assert len(rows) == 4 and all(json.loads(r.raw_data) == {"pagination": {"total": 1}, "data": [json.loads(r._record)]} for r in rows)
    assert derived.raw_flights(t).columns == ["raw_data", "source_file"]
