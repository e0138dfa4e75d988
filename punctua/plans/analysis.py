"""Columns and samples for the analysis of lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua import config
from punctua.config import DEFAULTS, Settings
from punctua.functions import batch_date, batch_id, flag, has_keyword, hours_between, merge_livery, time_of_day
from punctua.operators import measured, rare_to_other, sample_window

__all__ = ["model_sample", "model_table", "new_members", "prepare", "study_rows"]


def prepare(fact: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """B13, B14, B25, B27, B28. Trusted rows with the columns every analysis uses.

    Time of day follows the scheduled arrival: the actual one would move late flights into later slots.
    """
    pull = F.col("pull_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(cfg.run_hour_utc))
    return (
        measured(fact)
        .withColumns({
            "arrival_hour": F.hour("arrival_scheduled_local"),
            "is_sfo": F.col("arrival_airport") == config.BASE_AIRPORT,
            "carrier": merge_livery("operating_carrier_name"),
            "pull_date": batch_date("arrival_actual_utc", cfg.batch_shift_hours),
            "scheduled_duration_hours": hours_between("departure_scheduled_utc", "arrival_scheduled_utc"),
        })
        .withColumns({
            "time_of_day": time_of_day("arrival_hour"),
            "is_cargo": has_keyword("carrier", config.CARGO_WORDS),
            "is_non_scheduled": has_keyword("carrier", config.NON_SCHEDULED_WORDS),
            "hours_before_pull": hours_between("arrival_scheduled_utc", pull),
        }))


def model_table(rows: DataFrame) -> DataFrame:
    """B31, B35. The model's own columns, on any selection of prepared rows."""
    return rare_to_other(rows, "carrier", keep=config.MODEL_CARRIERS, name="carrier_group").withColumns({
        "is_late": F.col("is_delayed_arrival").cast("int"),
        "is_night": (F.col("arrival_hour") < 6).cast("int"),
        "cargo": F.col("is_cargo").cast("int"),
        "is_sfo": F.col("is_sfo").cast("int"),
        "batch": batch_id("pull_date", "arrival_airport"),
        "schedule_is_landing": has_keyword("carrier", config.SCHEDULE_IS_LANDING_WORDS),
        "missed_cargo": has_keyword("carrier", config.MISSED_CARGO_WORDS),
        "missed_non_scheduled": has_keyword("carrier", config.MISSED_NON_SCHEDULED_WORDS),
    })


def model_sample(prepared: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """C5. The sample fixed in advance: regular pulls, early enough, scheduled operators."""
    return model_table(sample_window(prepared, cfg.first_pull, cfg.last_pull, cfg.min_hours_before_pull))


def new_members(sample: DataFrame, history: DataFrame, col: str = "carrier") -> DataFrame:
    """D6. Values of the sample never seen before, with their row counts."""
    seen = history.select(col).where(F.col(col).isNotNull()).distinct()
    return sample.join(seen, col, "left_anti").groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def study_rows(prepared: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """All prepared rows with the model's columns, and a flag for each part of the sample rule.

    Checks that widen the sample combine the flags differently instead of reading the data again.
    """
    day = F.col("pull_date")
    rows = model_table(prepared).withColumns({
        "in_window": flag(day.between(F.lit(cfg.first_pull).cast("date"), F.lit(cfg.last_pull).cast("date"))),
        "early_enough": flag(F.col("hours_before_pull") >= cfg.min_hours_before_pull),
        "scheduled_operator": ~F.col("is_non_scheduled"),
        "manual_pull": flag(day.isin(*[F.lit(d).cast("date") for d in config.MANUAL_PULLS])),
        "date_batch": batch_id("flight_date", "arrival_airport"),
        "corrected_cargo": (F.col("is_cargo") | F.col("missed_cargo")).cast("int"),
    })
    return rows.withColumn("in_sample", F.col("in_window") & F.col("early_enough") & F.col("scheduled_operator"))
