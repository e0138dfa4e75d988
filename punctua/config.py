"""Settings and fixed values, in one place so that no two consumers can disagree."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Names, lists and patterns that must stay exactly as they are
# for results to be comparable between runs.
# --------------------------------------------------------------------------

CARGO_WORDS = (
    "Cargo|Fedex|Dhl|Ups|Abx Air|Atlas Air|Air Transport International|Amerijet|Kalitta"
    "|Aeronaves Tsm|Aerologic|Aitheras"
)
NON_SCHEDULED_WORDS = (
    "Flexjet|Netjets|Wheels Up|Vistajet|Selectjet|Reach Air Medical"
    "|Pegasus Elite|K&R Aviation|Revv Aviation|Ati Jet|Neajets|Baker Aviation"
    "|Airsprint|Planesense|Private Owner|Qatar Executive"
)
MISSED_CARGO_WORDS = "Carga|Western Global|21 Air|Ibc Airways|Ifl Group|^Mas$"
MISSED_NON_SCHEDULED_WORDS = (
    "Aerolineas Ejecutivas|Airshare|Flyexclusive|Fly Alliance|Jet Management"
    "|Zenflight|Vista America|Quest Diagnostics|Airsmart|Gridiron"
)
SCHEDULE_IS_LANDING_WORDS = (
    "Aeronaves Tsm|Avianca Cargo|Kalitta Air|Atlas Air|Amerijet|Dhl|Fedex"
    "|Star Peru|21 Air|Aerolineas Ejecutivas|Flexjet"
)
TIME_OF_DAY_LABELS = ("night (0-5)", "morning (6-11)", "afternoon (12-17)", "evening (18-23)")
STALENESS_LABELS = ("a. 0-30 min", "b. 31-60 min", "c. 61 min to threshold", "d. too stale, discarded")
RAIN_LEVELS = {"light rain": "light", "moderate rain": "moderate", "heavy intensity rain": "heavy"}
BIG_CARRIERS = ("United Airlines", "Alaska Airlines", "Delta Air Lines", "American Airlines")
MODEL_CARRIERS = ("United Airlines", "Delta Air Lines", "American Airlines", "Alaska Airlines")
BASE_CARRIER = "United Airlines"
MODEL_AIRPORTS = ("ATL", "EWR", "LAX", "MIA")
BASE_AIRPORT = "SFO"
MANUAL_PULLS = ("2026-09-04", "2026-09-05")
ANY_BRACKET = r"\s*\(.*\)"
LIVERY_BRACKET = r" *[(][^)]*Livery[)]$"
FILE_AIRPORT = r"/([A-Z]{3})_"
FILE_DATE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"
FILE_TIME = r"[A-Z]{3}_([0-9]{6})"


@dataclass(frozen=True)
class Settings:
    """Every threshold of the library. Pass a changed copy (``dataclasses.replace``)."""

    # fact table
    weather_max_lag_minutes: int = 120
    late_minutes: int = 15
    early_departure_minutes: int = 180
    duration_gap_minutes: int = 240
    retimed_departure_minutes: int = 60
    retimed_arrival_minutes: int = 1
    name_placeholder: str = "empty"
    name_default: str = "Unknown"

    # freshness
    weather_stale_minutes: int = 180
    flights_stale_hours: int = 54
    realert_hours: int = 6

    # request budget
    monthly_budget: int = 90
    run_hour_utc: int = 9

    # analysis sample
    batch_shift_hours: int = 15
    min_hours_before_pull: float = 2.0
    first_pull: str = "2026-09-07"
    last_pull: str = "2026-10-01"

    # as-of join: see operators.asof for what the width bounds
    asof_bucket_seconds: int = 3600
    asof_fan: int = 1024


DEFAULTS = Settings()
