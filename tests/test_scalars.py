from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from punctua import config, plans
from punctua import functions as X


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_wall_time_drops_the_offset_and_never_raises(spark):
    got = one(spark, X.wall_time(F.lit("2026-09-16T10:00:00+00:00")), X.wall_time(F.lit("2026-09-16T10:00:00-07:00")),
              X.wall_time(F.lit("soon")))
    assert got == (datetime(2026, 9, 16, 10), datetime(2026, 9, 16, 10), None)


@pytest.mark.parametrize("raw, want", [
    ("alaska airlines (oneworld livery)", "Alaska Airlines (Oneworld Livery)"), ("k&r aviation", "K&R Aviation"),
    ("o'hare charter", "O'hare Charter"), ("AIR-INDIA/express", "Air-India/Express"),
    ("aéro méxico", "Aéro México"), ("", ""), (None, None)])
def test_title_case(spark, raw, want):
    assert one(spark, X.title_case(F.lit(raw).cast("string"))) == (want,)


def test_clean_name(spark):
    assert one(spark, X.clean_name(F.lit("EMPTY")), X.clean_name(F.lit(None).cast("string")),
               X.clean_name(F.lit("delta air lines"))) == ("Unknown", "Unknown", "Delta Air Lines")


def test_boundaries_are_counted_not_elapsed_time(spark):
    assert one(spark, X.datediff_boundary("minute", ts("2026-01-01 10:00:59"), ts("2026-01-01 10:01:00")),
               X.datediff_boundary("hour", ts("2026-01-01 10:59:59"), ts("2026-01-01 11:00:00")),
               X.datediff_boundary("minute", ts("2026-01-01 10:01:00"), ts("2026-01-01 10:00:59")),
               X.datediff_boundary("day", ts("1969-12-31 23:59:59"), ts("1970-01-01 00:00:00"))) == (1, 1, -1, 1)


@pytest.mark.parametrize("zone, wall, ambiguous, utc", [
    ("America/New_York", "2026-11-01 01:30:00", True, None), ("America/New_York", "2026-03-08 02:30:00", True, None),
    ("America/New_York", "2026-11-01 00:59:59", False, datetime(2026, 11, 1, 4, 59, 59)),
    ("America/New_York", "2026-11-01 02:00:00", False, datetime(2026, 11, 1, 7)),
    ("Asia/Tokyo", "2026-11-01 01:30:00", False, datetime(2026, 10, 31, 16, 30)),
    (None, "2026-11-01 01:30:00", False, None), ("", "2026-11-01 01:30:00", False, None),
    ("Not/AZone", "2026-11-01 01:30:00", False, None), ("America/New_York", None, False, None)])
def test_local_times_are_converted_or_declared_unknown(spark, zone, wall, ambiguous, utc):
    df = spark.createDataFrame([(zone, wall)], "z STRING, w STRING").withColumn("w", F.col("w").cast("timestamp_ntz"))
    assert tuple(df.select(X.is_dst_ambiguous("z", "w"), X.local_to_utc("z", "w")).first()) == (ambiguous, utc)
    assert tuple(X.with_utc(df, [("z", "w", "u")], "amb").select("amb", "u").first()) == (ambiguous, utc)


def test_fall_back_night_is_measured_in_utc(spark):
    zone, a, b = F.lit("America/New_York"), ts("2026-11-01 00:50:00"), ts("2026-11-01 02:10:00")
    assert one(spark, X.delay_minutes(X.local_to_utc(zone, a), X.local_to_utc(zone, b), a, b)) == (140,)
    none = F.lit(None).cast("timestamp_ntz")
    assert one(spark, X.delay_minutes(none, none, a, b)) == (80,)


def test_file_keys(spark):
    new, old = "raw/flights/2026-09-09/ATL_090000_158798.json", "raw/weather/2026-09-04/203000.json"
    assert one(spark, X.file_airport(F.lit(new)), X.file_pulled_at(F.lit(new)), X.file_airport(F.lit(old)),
               X.file_pulled_at(F.lit(old))) == ("ATL", datetime(2026, 9, 9, 9), None, None)
    assert one(spark, X.file_pulled_at(F.lit("raw/flights/2026-09-09/ATL_997799_1.json"))) == (None,)


def test_numbers_and_epochs(spark):
    got = one(spark, X.safe_number(F.lit("12.7")), X.safe_number(F.lit("n/a")), X.rounded_int(F.lit(54.5)),
              X.epoch_utc(F.lit(1790000000)), X.safe_rate(F.lit(1), F.lit(0)), X.safe_rate(F.lit(1), F.lit(8), 1))
    assert got == (13, None, 55, datetime(2026, 9, 21, 14, 13, 20), None, 12.5)


def test_epoch_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, X.epoch_utc(F.lit(1790000000))) == (datetime(2026, 9, 21, 14, 13, 20),)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keywords(spark):
    assert one(spark, X.has_keyword(F.lit("Upstate Air"), config.CARGO_WORDS), X.has_keyword(F.lit("Mas"), config.MISSED_CARGO_WORDS),
               X.has_keyword(F.lit("Masai"), config.MISSED_CARGO_WORDS), X.has_keyword(F.lit(None).cast("string"), "x"),
               X.has_keyword(F.lit("k&r aviation"), config.NON_SCHEDULED_WORDS)) == (True, True, False, False, True)


def test_liveries(spark):
    name, other = F.lit("Alaska Airlines (Oneworld Livery)"), F.lit("Air X (Charter)")
    assert one(spark, X.merge_livery(name), X.merge_livery(name, True), X.merge_livery(other), X.merge_livery(other, True)) == (
        "Alaska Airlines", "Alaska Airlines", "Air X", "Air X (Charter)")


def test_bins_dates_and_keys(spark):
    assert one(spark, X.time_of_day(F.lit(5)), X.time_of_day(F.lit(6)), X.time_of_day(F.lit(24)),
               X.bin_right_closed(F.lit(2.0), [2, 4, 6]), X.bin_right_closed(F.lit(4.0), [2, 4, 6])) == (
        "night (0-5)", "morning (6-11)", None, None, "(2, 4]")
    assert one(spark, X.batch_date(ts("2026-09-16 08:59:59")), X.batch_date(ts("2026-09-16 09:00:00"))) == (
        date(2026, 9, 16), date(2026, 9, 17))
    assert one(spark, X.event_key(F.lit("DL1589"), ts("2026-09-16 10:00:00"))) == ("DL1589_2026-09-16 10:00:00.000",)
    assert one(spark, X.late_at(F.lit(13), 15, F.lit(True), 13), X.late_at(F.lit(13), 15)) == (True, False)


def test_carrier_code(spark):
    n = F.lit(None).cast("string")
    assert one(spark, X.carrier_code(F.lit("DL1589"), n, F.lit("VS"), n, n, n),
               X.carrier_code(n, F.lit("YX"), n, n, n, F.lit("LXJ12")),
               X.carrier_code(n, n, n, F.lit("LXJ"), n, n)) == ("DL", "LXJ", "LXJ")


def test_zones_without_a_region_convert(spark):
    rows = spark.createDataFrame([(z, datetime(2026, 7, 1, 12)) for z in ("GMT", "Japan", "EST5EDT", "Singapore", "Mars/Base")], "z STRING, w TIMESTAMP_NTZ")
    got = {r.z: r.u for r in rows.select("z", X.local_to_utc("z", "w").alias("u")).collect()}
    assert got == {"GMT": datetime(2026, 7, 1, 12), "Japan": datetime(2026, 7, 1, 3), "EST5EDT": datetime(2026, 7, 1, 16),
                   "Singapore": datetime(2026, 7, 1, 4), "Mars/Base": None}


def test_one_bad_record_leaves_the_others(spark):
    raw = spark.createDataFrame([(1, '{"data": [{"a": "x"}, 7, "text", null, {"a": 2}]}'), (2, '{"data": []}'), (3, "<html>")], "id INT, raw_data STRING")
    got = plans.flatten_records(raw, "STRUCT<a: STRING>").select("id", "r.a").collect()
    assert [(r.id, r.a) for r in got] == [(1, "x"), (1, None), (1, None), (1, None), (1, "2")]


def test_records_come_out_of_the_one_parse_of_their_document(spark):
    """No record is parsed again behind its document; a document with an odd part still keeps its other records."""
    good = '{"a": "x", "s": {"b": 1.5}}'
    odd = ['"text"', "null", "5", "[]", f"[{good}]", '{"a": "y", "s": "no struct"}', '{"s": [1], "a": {"c": 1}}', '"{\\"a\\": \\"inside\\"}"', '{"_odd": "z"}']
    docs = [f'{{"data": [{good}, {r}, {good}]}}' for r in odd] + [None, "", "{", "[]", '{"data": {}}', '{"data": []}', f'{{"data": [{good}', f'[{{"data": [{good}]}}]']
    raw = spark.createDataFrame(list(enumerate(docs)), "id INT, raw_data STRING")
    record = "STRUCT<a: STRING, s: STRUCT<b: STRING>>"
    got = plans.flatten_records(raw, record)
    behind = got._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "from_json" not in behind
    one_by_one = raw.select("id", F.explode(F.from_json("raw_data", "data ARRAY<STRING>")["data"]).alias("t")).select("id", F.from_json("t", record).alias("r"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, one_by_one.collect()))
