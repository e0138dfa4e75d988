"""The fact table: one row per physical flight and scheduled departure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.config import DEFAULTS, Settings
from punctua.functions import carrier_code, clean_name, datediff_boundary, event_key, first_known, flag
from punctua.operators import Probe, asof_probes, collapse_parts, collapse_with_count, gate_columns, identified, in_scope, latest_by, time_bucket
from punctua.plans.staging import time_flights

__all__ = [
    "FACT_COLUMNS", "attribute", "build_fact", "delay_flags", "has_retimed_schedule", "has_suspect_times",
    "event_rows", "events_of_labels", "label_rows", "physical_events", "series_readings", "with_both_readings", "with_reading",
]

DESIGNATORS = ("codeshare_flight_iata", "flight_iata", "flight_icao")

# Reading column -> fact column, in table order.
WEATHER_COLUMNS = {
    "weather_main": "weather_main", "weather_description": "weather_description", "temp_f": "weather_temp_f",
    "humidity": "weather_humidity", "wind_speed": "weather_wind_speed", "wind_gust": "weather_wind_gust",
    "visibility_m": "weather_visibility_m", "cloud_cover_pct": "weather_cloud_cover_pct",
}

FACT_COLUMNS = (
    "flight_event_key", "flight_date", "operating_flight_iata", "operating_carrier_code", "operating_carrier_name",
    "marketing_flight_iata", "marketing_carrier_name", "marketing_label_count", "has_codeshare_partners",
    "aircraft_icao24", "departure_airport", "arrival_airport", "departure_timezone", "arrival_timezone",
    "departure_scheduled_local", "departure_actual_local", "departure_scheduled_utc", "departure_actual_utc",
    "departure_delay_minutes", "arrival_scheduled_local", "arrival_actual_local", "arrival_scheduled_utc",
    "arrival_actual_utc", "arrival_delay_minutes", "minutes_recovered", "is_delayed_departure", "is_delayed_arrival",
    "source_departure_delay_minutes", "source_arrival_delay_minutes", "has_suspect_times",
    "has_retimed_arrival_schedule", "has_dst_ambiguous_time", "weather_observed_at", "weather_lag_minutes",
    "has_weather_match", *WEATHER_COLUMNS.values(),
)

# What an event takes over from its label, and the file by which the newest label is found: nothing else is shuffled.
_MADE = ("flight_event_key", "marketing_label_count", "has_codeshare_partners", "minutes_recovered", "is_delayed_departure", "is_delayed_arrival",
         "has_suspect_times", "has_retimed_arrival_schedule", "weather_observed_at", "weather_lag_minutes", "has_weather_match", *WEATHER_COLUMNS.values())
_CARRIED = (*(c for c in FACT_COLUMNS if c not in _MADE), "source_file")
# What follows from the wall times and zones of a label: rows that are only typed yet get it once they are events.
_TIMED = ("departure_scheduled_utc", "departure_actual_utc", "arrival_scheduled_utc", "arrival_actual_utc", "has_dst_ambiguous_time",
          "departure_delay_minutes", "arrival_delay_minutes")


def has_suspect_times(dep: Column, arr: Column, dst: Column, cfg: Settings = DEFAULTS) -> Column:
    """B21. Left hours early, flew hours off plan, or touches an unknowable local hour."""
    return (flag(dep < -cfg.early_departure_minutes)
            | flag(F.abs(arr - dep) > cfg.duration_gap_minutes) | flag(dst))


def has_retimed_schedule(dep: Column, arr: Column, cfg: Settings = DEFAULTS) -> Column:
    """B22. Left late yet "arrived" on the minute: the schedule was moved onto the landing."""
    return flag((dep >= cfg.retimed_departure_minutes) & (F.abs(arr) <= cfg.retimed_arrival_minutes))


def delay_flags(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """B21-B23. Quality and lateness flags. Exactly the threshold counts as late."""
    dep, arr = F.col("departure_delay_minutes"), F.col("arrival_delay_minutes")
    return df.withColumns({
        "minutes_recovered": dep - arr,
        "is_delayed_departure": flag(dep >= cfg.late_minutes),
        "is_delayed_arrival": flag(arr >= cfg.late_minutes),
        "has_suspect_times": has_suspect_times(dep, arr, F.col("has_dst_ambiguous_time"), cfg),
        "has_retimed_arrival_schedule": has_retimed_schedule(dep, arr, cfg),
    })


def attribute(staged: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """B8-B11. Who flew it, under which name, and which label the row is."""
    return _clean_names(_identify(staged), cfg)


def _identify(staged: DataFrame) -> DataFrame:
    return staged.withColumns({
        "operating_flight_iata": first_known(*DESIGNATORS),
        "operating_carrier_code": carrier_code("codeshare_flight_iata", "codeshare_airline_iata", "airline_iata",
                                               "airline_icao", "flight_iata", "flight_icao"),
        "operating_carrier_name": F.coalesce("codeshare_airline_name", "airline_name"),
        "marketing_carrier_name": F.col("airline_name"),
        "marketing_flight_iata": F.coalesce("flight_iata", "flight_icao"),
    })


def _clean_names(rows: DataFrame, cfg: Settings) -> DataFrame:
    return rows.withColumns({c: clean_name(c, cfg.name_placeholder, cfg.name_default)
                             for c in ("operating_carrier_name", "marketing_carrier_name")})


def physical_events(attributed: DataFrame, dealt: tuple[str, ...] = (), tap: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """F1 then F2. Re-pulled labels go first; only then are labels counted and collapsed.

    Both steps have the departure in their keys, so rows dealt by it are shuffled once for the two. Rows without a departure
    would all meet in one task and are dealt by each step's whole key. ``dealt`` names columns that follow from the departure and by which
    the rows with one are dealt already.

    With ``tap`` all rows are read once: those without a departure are dealt by their label and collapsed as far as that goes. ``tap`` writes the result and
    reads it back; only then do the parts of events without a departure meet.
    """
    departure = "departure_scheduled_local"

    def steps(rows: DataFrame, dealt: tuple[str, ...] = dealt) -> DataFrame:
        labels = latest_by(rows, [*dealt, "marketing_flight_iata", departure],
                           [F.desc_nulls_last("arrival_actual_local"), F.desc_nulls_last("source_file"),
                            F.asc_nulls_last("operating_flight_iata")])
        return collapse_with_count(labels, [*dealt, "operating_flight_iata", departure], ["marketing_flight_iata"],
                                   "marketing_label_count")

    if tap is not None:
        lane = F.when(F.col(departure).isNull(), F.coalesce("marketing_flight_iata", F.lit("")))
        parts = tap(steps(attributed.withColumn("_lane", lane).repartition(departure, "_lane"), ("_lane",)).drop("_lane"))
        return parts.where(F.col(departure).isNotNull()).unionByName(collapse_parts(
            parts.where(F.col(departure).isNull()), ["operating_flight_iata", departure], ["marketing_flight_iata"], "marketing_label_count"))
    timed = attributed.where(F.col(departure).isNotNull())
    return steps(timed if dealt else timed.repartition(departure)).unionByName(steps(attributed.where(F.col(departure).isNull())))


def series_readings(weather: DataFrame, dealt: str | None = None, cfg: Settings = DEFAULTS) -> DataFrame:
    """F3. One reading per place and time, from the newest file.

    With ``dealt`` the rows are shuffled by place and time bucket, which is kept under that name, so the as-of join that follows needs no shuffle of its own.
    """
    known, keys = weather.where(F.col("iata_code").isNotNull()), ["iata_code", "observed_at"]
    if dealt is not None:
        known, keys = known.withColumn(dealt, time_bucket("observed_at", cfg.asof_bucket_seconds)).repartition("iata_code", dealt), [*keys, dealt]
    return latest_by(known, keys, [F.desc_nulls_last("source_file")])


_FRESH = {"weather_observed_at": "observed_at", **{c: c for c in WEATHER_COLUMNS}}


def _with_probes(events: DataFrame, readings: DataFrame, probes: list[Probe], cfg: Settings, dealt: str | None = None,
                 tap: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    matched = asof_probes(events, readings.withColumnRenamed("iata_code", "arrival_airport"), ["arrival_airport"], "observed_at", probes,
                          bucket_seconds=cfg.asof_bucket_seconds, fan=cfg.asof_fan, dealt=dealt, tap=tap)
    lag = datediff_boundary("minute", "weather_observed_at", "arrival_actual_utc")
    scored = matched.withColumn("weather_lag_minutes", lag).withColumn(
        "has_weather_match", flag(F.col("weather_lag_minutes") <= cfg.weather_max_lag_minutes))
    return gate_columns(scored, "has_weather_match", WEATHER_COLUMNS)


def with_reading(events: DataFrame, readings: DataFrame, cfg: Settings = DEFAULTS, dealt: str | None = None,
                 tap: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D2, B16, B24. Latest reading at or before arrival; values only while fresh, the lag always. ``dealt`` and ``tap`` are those of ``asof_probes``."""
    return _with_probes(events, readings, [Probe("arrival_actual_utc", _FRESH)], cfg, dealt, tap)


def with_both_readings(events: DataFrame, readings: DataFrame, cfg: Settings = DEFAULTS, dealt: str | None = None,
                       tap: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D2, D3, L16. ``with_reading``, plus the wind at the scheduled arrival within an elapsed tolerance: a reading no delay can move.

    Both times are probes of one timeline, so the readings are shuffled once.
    """
    return _with_probes(events, readings, [
        Probe("arrival_actual_utc", _FRESH),
        Probe("arrival_scheduled_utc", {"wind_at_schedule": "wind_speed"}, 60 * cfg.weather_max_lag_minutes)], cfg, dealt, tap)


def event_rows(staged: DataFrame, airports: DataFrame, cfg: Settings = DEFAULTS, tap: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The events of staged rows with keys and flags, before any reading joins them."""
    return events_of_labels(label_rows(staged, airports, cfg), cfg, tap)


def label_rows(staged: DataFrame, airports: DataFrame, cfg: Settings = DEFAULTS, kept: tuple[str, ...] = ()) -> DataFrame:
    """The labels in scope of staged or typed rows, with what an event takes over from them, and ``kept``. Names are as staged: only those of events are cleaned."""
    scoped = identified(in_scope(staged, airports, "arrival_airport", "iata_code"), *DESIGNATORS)
    return _identify(scoped).select(*[c for c in _CARRIED if c not in _TIMED or c in staged.columns], *kept)


def events_of_labels(labels: DataFrame, cfg: Settings = DEFAULTS, tap: Callable[[DataFrame], DataFrame] | None = None,
                     dealt: tuple[str, ...] = ()) -> DataFrame:
    """The events of labels with keys and flags. Labels that are only typed are timed as events, of which there are fewer."""
    timed = (lambda rows: rows) if set(_TIMED) <= set(labels.columns) else time_flights
    if tap is None:
        collapsed = timed(physical_events(labels, dealt))
    else:
        collapsed = physical_events(labels, dealt, lambda parts: tap(timed(parts.drop("source_file"))))
    return delay_flags(_clean_names(collapsed.drop("source_file"), cfg), cfg).withColumns({
        "flight_event_key": event_key("operating_flight_iata", "departure_scheduled_local"),
        "has_codeshare_partners": F.col("marketing_label_count") > 1,
    })


def build_fact(staged: DataFrame, weather: DataFrame, airports: DataFrame, cfg: Settings = DEFAULTS,
               at_schedule: bool = False, tap: Callable[[DataFrame], DataFrame] | None = None,
               tap_points: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The 43-column fact table (plus ``wind_at_schedule`` on request), as one lazy plan.

    ``staged`` are rows of ``stage_flights``, or of ``type_flights`` where nobody else needs the staged table: then only events have their times converted.
    ``tap`` sees the collapsed labels before the weather joins, and ``tap_points`` the times that were looked up among the readings. Both are read more than
    once from there on, so a job over a large landing zone passes ``DataFrame.checkpoint`` or writes them here; staged rows and readings are then read once.
    """
    events = event_rows(staged, airports, cfg, tap)
    readings = series_readings(weather, "_bucket", cfg)
    if at_schedule:
        return with_both_readings(events, readings, cfg, "_bucket", tap_points).select(*FACT_COLUMNS, "wind_at_schedule")
    return with_reading(events, readings, cfg, "_bucket", tap_points).select(*FACT_COLUMNS)
