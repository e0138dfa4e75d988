"""Staging: flatten and type the raw documents. No modelling decisions here."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions import (delay_minutes, epoch_utc, file_airport, rounded_int, safe_number, wall_time,
                               with_utc)

__all__ = ["field_profile", "flatten_documents", "flatten_records", "stage_flights", "stage_weather", "time_flights", "type_flights"]

# Leaves are text, so that a value of an unexpected JSON type is cast (or becomes NULL) in one place
# instead of making the whole document unreadable.
_END = ("STRUCT<iata: STRING, timezone: STRING, scheduled: STRING, actual: STRING, actual_runway: STRING,"
        " delay: STRING>")
FLIGHT_RECORD = (
    "STRUCT<flight_date: STRING, flight_status: STRING,"
    " airline: STRUCT<name: STRING, iata: STRING, icao: STRING>,"
    " flight: STRUCT<iata: STRING, icao: STRING,"
    " codeshared: STRUCT<airline_name: STRING, airline_iata: STRING, flight_iata: STRING>>,"
    f" aircraft: STRUCT<icao24: STRING>, departure: {_END}, arrival: {_END}>"
)
_SKIES = "ARRAY<STRUCT<main: STRING, description: STRING>>"


def _weather_schema(number: str, seconds: str) -> str:
    return (f"name STRING, coord STRUCT<lat: {number}, lon: {number}>,"
            f" main STRUCT<temp: {number}, feels_like: {number}, humidity: {number}, pressure: {number}>,"
            f" wind STRUCT<speed: {number}, gust: {number}>, visibility {number}, clouds STRUCT<`all`: {number}>,"
            f" weather {_SKIES}, dt {seconds}")


WEATHER_DOCUMENT = _weather_schema("STRING", "STRING")
_WEATHER_NUMBERS = _weather_schema("DOUBLE", "BIGINT") + ", _odd STRING"


def flatten_records(raw: DataFrame, record: str, path: str = "data", raw_col: str = "raw_data",
                    name: str = "r") -> DataFrame:
    """B1. One row per record of a document's list; a document with no records gives no rows.

    A document is parsed once, records and all. Where any part of it is of another type, its records are read one by one instead, so a record of
    another type becomes one of NULL fields and leaves the others as they are.
    """
    kept = [c for c in raw.columns if c != raw_col]
    parsed = raw.withColumn("_doc", F.from_json(raw_col, f"`{path}` ARRAY<{record}>, _odd STRING", {"columnNameOfCorruptRecord": "_odd"}))
    single = F.transform(F.from_json(raw_col, f"`{path}` ARRAY<STRING>")[path], lambda text: F.from_json(text, record))
    return parsed.select(*kept, F.explode(F.when(F.col("_doc._odd").isNull(), F.col("_doc")[path]).otherwise(single)).alias(name))


def flatten_documents(docs: DataFrame, path: str = "data", doc: str = "doc", name: str = "record") -> DataFrame:
    """B1. One row per record of a ``VARIANT`` body, the record itself a variant, so that fields nobody has listed yet survive."""
    kept = [c for c in docs.columns if c != doc]
    return docs.select(*kept, F.explode(F.try_variant_get(doc, f"$.{path}", "array<variant>")).alias(name))


def field_profile(records: DataFrame, record: str = "record", depth: int = 2) -> DataFrame:
    """A6, B1. (field, type, records): the fields that records have, ``depth`` levels deep, and as what type; an upstream change shows here first.

    Members of a record are exploded in place and counted with map-side combine, so a task sends one row per field and type.
    """
    tvf, level, parts = records.sparkSession.tvf, records.select(F.lit(None).cast("string").alias("_at"), F.col(record).alias("_v")), []
    for _ in range(depth):
        members = level.alias("l").lateralJoin(tvf.variant_explode(F.col("l._v").outer()).alias("m")).where(F.col("m.key").isNotNull())
        level = members.select(F.concat_ws(".", "l._at", "m.key").alias("_at"), F.col("m.value").alias("_v"))
        kind = F.regexp_extract(F.schema_of_variant("_v"), "^[A-Z]+", 0)
        parts.append(level.select(F.col("_at").alias("field"), kind.alias("type")))
    return reduce(DataFrame.unionByName, parts).groupBy("field", "type").agg(F.count(F.lit(1)).alias("records"))


def _typed_records(raw: DataFrame) -> DataFrame:
    """Flight records from parsed bodies (``doc``) where there are any, else from text."""
    if "doc" not in raw.columns:
        return flatten_records(raw, FLIGHT_RECORD)
    return flatten_documents(raw).select("source_file", F.try_variant_get("record", "$", FLIGHT_RECORD).alias("r"))


_ZONED = [(f"{end}_timezone", f"{end}_{kind}") for end in ("departure", "arrival") for kind in ("scheduled", "actual")]


def type_flights(raw: DataFrame) -> DataFrame:
    """B2, B4, B6, B7. One row per marketing label per file, its times as wall times only; bodies are text (``raw_data``) or parsed (``doc``)."""
    r = F.col
    return _typed_records(raw).select(
        r("r.flight_date").try_cast("date").alias("flight_date"),
        r("r.flight_status").alias("flight_status"),
        r("r.airline.name").alias("airline_name"),
        r("r.airline.iata").alias("airline_iata"),
        r("r.airline.icao").alias("airline_icao"),
        r("r.flight.iata").alias("flight_iata"),
        r("r.flight.icao").alias("flight_icao"),
        F.upper("r.flight.codeshared.flight_iata").alias("codeshare_flight_iata"),
        r("r.flight.codeshared.airline_name").alias("codeshare_airline_name"),
        F.upper("r.flight.codeshared.airline_iata").alias("codeshare_airline_iata"),
        r("r.aircraft.icao24").alias("aircraft_icao24"),
        *[r(f"r.{end}.{field}").alias(f"{end}_{name}") for end in ("departure", "arrival")
          for field, name in (("iata", "airport"), ("timezone", "timezone"))],
        *[wall_time(f"r.{end}.{kind}").alias(f"{end}_{kind}_local") for end in ("departure", "arrival")
          for kind in ("scheduled", "actual")],
        *[safe_number(f"r.{end}.delay").alias(f"source_{end}_delay_minutes") for end in ("departure", "arrival")],
        r("source_file"),
    )


def time_flights(typed: DataFrame) -> DataFrame:
    """B18-B20. Typed flights, or events that took over their times and zones, with UTC instants, the flag of unknowable hours and delays.

    Each row is judged by itself, so it makes no difference whether labels are timed or, later, the events that some of them became.
    """
    converted = with_utc(typed, [(zone, f"{at}_local", f"{at}_utc") for zone, at in _ZONED], "has_dst_ambiguous_time")

    def delay(end: str):
        s, a = f"{end}_scheduled", f"{end}_actual"
        return delay_minutes(f"{s}_utc", f"{a}_utc", f"{s}_local", f"{a}_local")

    return converted.withColumns({f"{end}_delay_minutes": delay(end) for end in ("departure", "arrival")})


def stage_flights(raw: DataFrame) -> DataFrame:
    """B2, B4, B6, B7, B18-B20. One row per marketing label per file, 29 columns; bodies are text (``raw_data``) or parsed (``doc``)."""
    return time_flights(type_flights(raw)).select(
        "flight_date", "flight_status", "airline_name", "airline_iata", "airline_icao", "flight_iata", "flight_icao",
        "codeshare_flight_iata", "codeshare_airline_name", "codeshare_airline_iata", "aircraft_icao24",
        "departure_airport", "departure_timezone", "arrival_airport", "arrival_timezone",
        *[f"{at}_local" for _, at in _ZONED], *[f"{at}_utc" for _, at in _ZONED], "has_dst_ambiguous_time",
        "departure_delay_minutes", "arrival_delay_minutes",
        "source_departure_delay_minutes", "source_arrival_delay_minutes", "source_file")


def _weather_bodies(raw: DataFrame) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """Readings, and how to take from them the value of a path as a type.

    Numbers are parsed as numbers, which is cheaper than as text. Where any part of a document is of another type, all its leaves are
    read as text and cast, so an odd value becomes NULL by itself and leaves the others as they are. A number too large for a double is NULL.
    """
    if "doc" in raw.columns:
        body = F.try_variant_get("doc", "$", f"STRUCT<{WEATHER_DOCUMENT}>")
        return raw.select(body.alias("d"), "source_file"), lambda path, kind: F.col(f"d.{path}").try_cast(kind)
    fast = F.from_json("raw_data", _WEATHER_NUMBERS, {"columnNameOfCorruptRecord": "_odd", "allowNonNumericNumbers": "false"})
    plain = F.col("n._odd").isNull()
    bodies = raw.select(fast.alias("n"), "raw_data", "source_file").select(
        "n", plain.alias("plain"), F.when(~plain, F.from_json("raw_data", WEATHER_DOCUMENT)).alias("d"), "source_file")

    def value(path: str, kind: str) -> Column:
        number = F.col(f"n.{path}")
        if kind == "double":
            number = F.when(F.abs(number) < F.lit(float("inf")), number)
        return F.when(F.col("plain"), number).otherwise(F.col(f"d.{path}").try_cast(kind))

    return bodies, value


def stage_weather(raw: DataFrame) -> DataFrame:
    """B3, B5, B12. One row per reading per file, 16 columns. The place comes from the file's key."""
    d, value = _weather_bodies(raw)

    def num(path: str):
        return value(path, "double")

    first = F.get(value("weather", _SKIES), F.lit(0))
    return d.select(
        file_airport("source_file").alias("iata_code"),
        value("name", "string").alias("station_name"),
        num("coord.lat").alias("station_lat"), num("coord.lon").alias("station_lon"),
        num("main.temp").alias("temp_f"), num("main.feels_like").alias("feels_like_f"),
        rounded_int(num("main.humidity")).alias("humidity"), rounded_int(num("main.pressure")).alias("pressure"),
        num("wind.speed").alias("wind_speed"), num("wind.gust").alias("wind_gust"),
        rounded_int(num("visibility")).alias("visibility_m"), rounded_int(num("clouds.all")).alias("cloud_cover_pct"),
        first["main"].alias("weather_main"), first["description"].alias("weather_description"),
        epoch_utc(value("dt", "bigint")).alias("observed_at"),
        "source_file")
