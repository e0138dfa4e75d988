"""Deduplication, as-of joins and the fact flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.catalog import derived
from punctua.catalog.derived import STAGING_SQL, fact_sql
from punctua.catalog.registry import Tables, query
from punctua.functions import datediff_boundary, flag, staleness_bucket, to_double
from punctua.operators import (asof_join, carry_forward, collapse_with_count, counts, distinct_values, gate_columns, holdout_before,
                               latest_by, sample_window)
from punctua.plans import FACT_COLUMNS, build_fact, field_profile, flatten_documents, new_members, series_readings, stage_flights, stage_weather
from punctua.sources import read_documents
from punctua.streaming import changed_events, refresh_events

LINE_ORDER = [F.desc_nulls_last, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_LATEST_SQL = """
  select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc nulls last, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc) = 1"""


def _latest_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                              "l_shipdate")
    return latest_by(lines, ["l_orderkey", "l_linenumber"], [LINE_ORDER[0](c) for c in LINE_ORDER[1:]])


@query("latest_wins", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
from ({_LATEST_SQL})""")
def latest_wins(t: Tables) -> DataFrame:
    """F1. The newest row per key."""
    return _latest_lines(t)


@query("two_step_collapse", f"""
with latest as ({_LATEST_SQL}),
collapsed as (
  select *, count(*) over (partition by l_orderkey) as label_count from latest
  qualify row_number() over (partition by l_orderkey order by l_linenumber) = 1)
select label_count as labels, count(*) as events, sum(l_partkey)::bigint as first_part_sum,
  max(l_shipdate) as last_shipdate from collapsed group by 1""")
def two_step_collapse(t: Tables) -> DataFrame:
    """F1, F2, E7. Remove re-pulls, then count and collapse labels, then the histogram."""
    collapsed = collapse_with_count(_latest_lines(t), ["l_orderkey"], ["l_linenumber"], "label_count")
    return collapsed.groupBy(F.col("label_count").alias("labels")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("l_partkey").alias("first_part_sum"),
        F.max("l_shipdate").alias("last_shipdate"))


@query("collapse_with_count", f"""
with latest as ({_LATEST_SQL})
select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey) as label_count from latest
qualify row_number() over (partition by l_orderkey order by l_linenumber) = 1""")
def collapse_rows(t: Tables) -> DataFrame:
    """F2. One row per order with its number of labels."""
    return collapse_with_count(_latest_lines(t).select("l_orderkey", "l_linenumber", "l_partkey"),
                               ["l_orderkey"], ["l_linenumber"], "label_count")


def _arrivals(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("arrived_at"))


def _readings(t: Tables) -> DataFrame:
    seen = t.events.where("event_type = 'error'").select(
        "user_id", F.col("ts").alias("observed_at"), F.col("event_id").alias("reading_id"), "value")
    return latest_by(seen, ["user_id", "observed_at"], [F.desc("reading_id")])


def _matched(t: Tables, **options) -> DataFrame:
    return asof_join(_arrivals(t), _readings(t), ["user_id"], "arrived_at", "observed_at", ["reading_id", "value"],
                     **options)


_ASOF_SQL = """
with readings as (
  select user_id, ts as observed_at, event_id as reading_id, value from events where event_type = 'error'
  qualify row_number() over (partition by user_id, ts order by event_id desc) = 1),
arrivals as (select event_id, user_id, ts as arrived_at from events where event_type = 'purchase'),
matched as (
  select a.*, r.observed_at, r.reading_id, r.value, date_diff('minute', r.observed_at, a.arrived_at) as lag_minutes
  from arrivals a asof left join readings r on a.user_id = r.user_id and a.arrived_at >= r.observed_at),
scored as (select *, coalesce(lag_minutes <= 720, false) as has_match from matched)"""


def _scored(t: Tables) -> DataFrame:
    lag = datediff_boundary("minute", "observed_at", "arrived_at")
    return _matched(t).withColumn("lag_minutes", lag).withColumn("has_match", flag(F.col("lag_minutes") <= 720))


@query("asof_latest", f"""{_ASOF_SQL}
select event_id, user_id, arrived_at, observed_at, reading_id, value, lag_minutes from matched""")
def asof_latest(t: Tables) -> DataFrame:
    """D2, F3, B16. Latest reading at or before each arrival, however old."""
    return _matched(t).withColumn("lag_minutes", datediff_boundary("minute", "observed_at", "arrived_at"))


@query("asof_tolerance", f"""{_ASOF_SQL}
select event_id, user_id, arrived_at, case when fresh then observed_at end as observed_at,
  case when fresh then reading_id end as reading_id, case when fresh then value end as value
from (select *, epoch_us(arrived_at) - epoch_us(observed_at) <= 7200000000 as fresh from matched)""")
def asof_tolerance(t: Tables) -> DataFrame:
    """D3, F5. The same, but only within 120 elapsed minutes."""
    return _matched(t, tolerance_seconds=7200)


@query("asof_gated", f"""{_ASOF_SQL}
select event_id, user_id, arrived_at, observed_at, lag_minutes, has_match,
  case when has_match then reading_id end as matched_reading, case when has_match then value end as matched_value
from scored""")
def asof_gated(t: Tables) -> DataFrame:
    """B24. Values only while fresh; the lag stays visible on every row."""
    return gate_columns(_scored(t), "has_match", {"reading_id": "matched_reading", "value": "matched_value"})


@query("staleness_buckets", f"""{_ASOF_SQL}
select case when not has_match then 'd. too stale, discarded' when lag_minutes <= 30 then 'a. 0-30 min'
  when lag_minutes <= 60 then 'b. 31-60 min' else 'c. 61 min to threshold' end as bucket, count(*) as arrivals
from scored where lag_minutes is not null group by 1""")
def staleness_buckets(t: Tables) -> DataFrame:
    """B32, E8. How old the matched readings were."""
    return counts(_scored(t).where(F.col("lag_minutes").isNotNull()),
                  [staleness_bucket("lag_minutes", "has_match").alias("bucket")], "arrivals")


@query("carry_forward", """
select event_id, user_id, date_trunc('hour', ts) as ts, last_value(case when event_type = 'error' then value end ignore nulls)
  over (partition by user_id order by date_trunc('hour', ts), event_id rows between unbounded preceding and current row) as last_error
from events""")
def carry_forward_query(t: Tables) -> DataFrame:
    """F6. The last error value known at each event, by the as-of join, so no user is one sorted group."""
    errors = t.events.select("event_id", "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.when(F.col("event_type") == "error", F.col("value")).alias("v"))
    return carry_forward(errors, ["user_id"], "ts", "v", "event_id", "last_error").drop("v")


_FLIGHT_COLUMNS = (
    "flight_date", "flight_status", "airline_name", "airline_iata", "airline_icao", "flight_iata", "flight_icao",
    "codeshare_flight_iata", "codeshare_airline_name", "codeshare_airline_iata", "aircraft_icao24",
    "departure_airport", "departure_timezone", "arrival_airport", "arrival_timezone", "departure_scheduled_local",
    "departure_actual_local", "arrival_scheduled_local", "arrival_actual_local", "departure_scheduled_utc",
    "departure_actual_utc", "arrival_scheduled_utc", "arrival_actual_utc", "has_dst_ambiguous_time",
    "departure_delay_minutes", "arrival_delay_minutes", "source_departure_delay_minutes",
    "source_arrival_delay_minutes", "source_file")
_WEATHER_STAGED = (
    "iata_code", "station_name", "station_lat", "station_lon", "temp_f", "feels_like_f", "humidity", "pressure",
    "wind_speed", "wind_gust", "visibility_m", "cloud_cover_pct", "weather_main", "weather_description",
    "observed_at", "source_file")


def _plain(df: DataFrame) -> DataFrame:
    """Whole-number decimals as bigint, so both engines compare the same type."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in (
        "source_departure_delay_minutes", "source_arrival_delay_minutes")})


@query("stage_flights", f"{STAGING_SQL}\nselect {', '.join(_FLIGHT_COLUMNS)} from stg_flights")
def stage_flights_query(t: Tables) -> DataFrame:
    """B1, B2, B4, B6, B7, B17-B20. Documents to typed rows, 29 columns."""
    return _plain(stage_flights(derived.raw_flights(t)))


@query("stage_weather", f"{STAGING_SQL}\nselect {', '.join(_WEATHER_STAGED)} from stg_weather")
def stage_weather_query(t: Tables) -> DataFrame:
    """B3, B5, B12. Documents to readings, 16 columns."""
    return stage_weather(derived.raw_weather(t))


def _landed_by_aircraft(t: Tables) -> DataFrame:
    """The flight documents as real files, one for each aircraft, read back with parsed bodies; the key of a file is its aircraft.

    An aircraft stands for a supplier, whose number of line items does not grow with the data: files become more, not longer. Each record is a
    line of its file, so no task gathers a file, and files are compressed, as fields repeat their names in every record.
    """
    def write(path: str) -> None:
        line = F.concat(F.when(F.col("_first"), '{"data": [').otherwise(","), F.col("_record"), F.when(F.col("_last"), "]}").otherwise(""))
        (derived.raw_flights_by_aircraft(t).select(line.alias("value"), F.col("_aircraft").alias("aircraft"))
         .write.partitionBy("aircraft").option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip"))

    path = derived.landing_folder(t, "raw-by-aircraft", write)
    return read_documents(t.spark, path, "*.txt.gz").withColumn("source_file", F.regexp_extract("source_file", "aircraft=([^/]+)/", 1))


@query("landing_documents", f"""{STAGING_SQL}
select {', '.join(c for c in _FLIGHT_COLUMNS if c != 'source_file')}, aircraft_icao24 as source_file from stg_flights""")
def landing_documents(t: Tables) -> DataFrame:
    """A1, B1-B3. Files of many records each, listed and read by the executors, parsed once into a variant, and staged from it."""
    return _plain(stage_flights(_landed_by_aircraft(t)))


_FIELDS = {"flight_date": "flight_date", "flight_status": "flight_status", "airline.name": "airline_name", "airline.iata": "airline_iata",
           "flight.iata": "flight_iata", "flight.icao": "flight_icao", "arrival.actual": "arrival_actual_local",
           "departure.timezone": "departure_timezone"}


@query("field_profile", f"""{STAGING_SQL},
wanted as ({" union all ".join(f"select '{f}' as field, {c} is null as missing from stg_flights" for f, c in _FIELDS.items())})
select field, case when missing then 'VOID' else 'STRING' end as type, count(*) as records from wanted group by all""")
def field_profile_query(t: Tables) -> DataFrame:
    """A6, B1. Of the landed records, which fields have which type; nothing about them is declared beforehand."""
    return field_profile(flatten_documents(_landed_by_aircraft(t))).where(F.col("field").isin(*_FIELDS))


@query("fact_events", fact_sql(f"select {', '.join(FACT_COLUMNS)} from fact"))
def fact_events(t: Tables) -> DataFrame:
    """The 43-column fact: scope, attribution, F1, F2, flags, as-of reading, gating."""
    return _plain(derived.fact(t))


@query("fact_wind_at_schedule", fact_sql("""
select f.flight_event_key, f.arrival_scheduled_utc,
  case when epoch_us(f.arrival_scheduled_utc) - epoch_us(r.observed_at) <= 7200000000 then r.w.wind_speed end
    as wind_at_schedule
from fact f asof left join reading r on f.arrival_airport = r.iata_code and f.arrival_scheduled_utc >= r.observed_at"""))
def fact_wind_at_schedule(t: Tables) -> DataFrame:
    """D3, L16. The reading at the scheduled time, which no delay can move."""
    return derived.fact_table(t).select("flight_event_key", "arrival_scheduled_utc", "wind_at_schedule")


@query("refresh_events", fact_sql(f"select {', '.join(FACT_COLUMNS)} from fact"))
def refresh_events_query(t: Tables) -> DataFrame:
    """K3. A fact without a fifth of the flight and weather files, brought up to date by them; equals the fact of all files."""
    flights, weather, dim = derived.flights_table(t), derived.weather_table(t), derived.airports(t)
    late = F.crc32(F.col("source_file").cast("binary")) % 5 == 0
    before = derived.written(t, "fact-before", lambda: build_fact(flights.where(~late), weather.where(~late), dim))
    unmatched = [c for c in FACT_COLUMNS if not c.startswith("weather_") and c != "has_weather_match"]
    events = derived.written(t, "fact-events", lambda: build_fact(flights, weather.where(F.lit(False)), dim).select(*unmatched))
    places = weather.where(late).select(F.col("iata_code").alias("arrival_airport"), "observed_at")
    return _plain(refresh_events(before, events, series_readings(weather), changed_events(flights, flights.where(late), dim), places))


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("sample_window", f"""select {_LINE} from lineitem
where l_shipdate between date '1994-01-01' and date '1995-06-30' and l_quantity >= 10 and l_returnflag <> 'R'""")
def sample_window_query(t: Tables) -> DataFrame:
    """C5. Batches of a closed range of dates, early enough, without the excluded ones."""
    lines = t.lineitem.withColumn("excluded", F.col("l_returnflag") == "R")
    return sample_window(lines, "1994-01-01", "1995-06-30", 10, "l_shipdate", "l_quantity", "excluded").select(*_LINE.split(", "))


@query("holdout_before", "select l_returnflag, count(*) as rows from lineitem where l_shipdate <= date '1996-06-30' group by 1")
def holdout_before_query(t: Tables) -> DataFrame:
    """C7. Batches up to and including a date."""
    return holdout_before(t.lineitem, "l_shipdate", "1996-06-30").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@query("distinct_values", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def distinct_values_query(t: Tables) -> DataFrame:
    """G4."""
    return distinct_values(t.lineitem, "l_returnflag", "l_linestatus", "l_linenumber")


@query("to_double", f"select {_LINE}, l_extendedprice::decimal(15,1)::double as price, l_tax::decimal(6,2)::double as tax from lineitem")
def to_double_query(t: Tables) -> DataFrame:
    """B36. Decimals of a table as double, other columns untouched."""
    return to_double(t.lineitem.select(*_LINE.split(", "), F.col("l_extendedprice").cast("decimal(15,1)").alias("price"),
                                       F.col("l_tax").cast("decimal(6,2)").alias("tax")))


@query("new_members", """select l_orderkey, count(*) as rows from lineitem where l_quantity > 40
and l_orderkey not in (select l_orderkey from lineitem where l_quantity <= 30) group by 1""")
def new_members_query(t: Tables) -> DataFrame:
    """D6. Orders of a sample that the history does not know, with their rows."""
    return new_members(t.lineitem.where("l_quantity > 40"), t.lineitem.where("l_quantity <= 30"), "l_orderkey")
