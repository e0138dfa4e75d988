"""Freshness: is data arriving, for every expected member, and does it add anything new?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.config import DEFAULTS, Settings
from punctua.functions import age, file_airport, file_pulled_at
from punctua.operators import asof_join, left_from_dim

__all__ = [
    "age_per_member", "carry_result", "file_clock", "freshness_problems", "freshness_text", "newest_age",
    "problem_signature", "utc_now",
]


def utc_now() -> Column:
    """M10. Now, as a UTC wall time like the data. Jobs that must repeat pass a fixed ``as_of``."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def newest_age(df: DataFrame, at: str, as_of: Column, unit: str = "minute", name: str = "age") -> DataFrame:
    """J1. Age of the newest row; NULL for a table without any usable time."""
    return df.agg(F.max(at).alias("_t")).select(age(unit, "_t", as_of).alias(name))


def age_per_member(dim: DataFrame, df: DataFrame, key: str, at: str, as_of: Column, unit: str = "minute",
                   name: str = "age") -> DataFrame:
    """J2. Age per expected member. A member that never delivered has a NULL age, not a missing row."""
    return left_from_dim(dim, df.where(F.col(key).isNotNull()), key, _t=F.max(at)).select(
        key, age(unit, "_t", as_of).alias(name))


def file_clock(staged: DataFrame) -> DataFrame:
    """J5. When each staged row's file was pulled. Files without records have no staged rows, so they never tick."""
    return staged.select(file_airport("source_file").alias("iata_code"),
                         file_pulled_at("source_file").alias("pulled_at"))


def freshness_problems(dim: DataFrame, stg_weather: DataFrame, stg_flights: DataFrame, fact: DataFrame, as_of: Column,
                       cfg: Settings = DEFAULTS) -> DataFrame:
    """J3, J4. One row per problem: (source, member, age, detail); ``member`` is NULL for a whole source.

    An unknown age is a problem of its own. Members are only listed while their source as a whole is
    fresh, and arrivals are only asked about while files keep landing.
    """
    hours = cfg.weather_stale_minutes / 60
    in_hours = lambda c: F.when(c.isNotNull(), F.format_string("%.1fh", c / F.lit(60.0)))
    plain = lambda c: F.concat(c.cast("string"), F.lit("h"))
    files = file_clock(stg_flights)

    def source(kind: str, df: DataFrame, key: str, at: str, unit: str, limit: int, show, unknown: str, stale: str,
               stale_member: str) -> tuple[Column, DataFrame]:
        whole = newest_age(df, at, as_of, unit).withColumns({"source": F.lit(kind), "member": F.lit(None).cast("string")})
        fresh = F.coalesce(whole.select("age").scalar() <= limit, F.lit(False))
        members = age_per_member(dim, df, key, at, as_of, unit).where(fresh).select(
            F.lit(kind).alias("source"), F.col(key).alias("member"), "age")
        problems = whole.select("source", "member", "age").unionByName(members).where(
            F.col("age").isNull() | (F.col("age") > limit))
        detail = (F.when(F.col("member").isNotNull(), F.concat(
                      F.lit(stale_member), F.col("member"), F.lit(" ("),
                      F.coalesce(show(F.col("age")), F.lit("no data")), F.lit(")")))
                  .when(F.col("age").isNull(), F.lit(unknown))
                  .otherwise(F.format_string(stale, show(F.col("age")))))
        return fresh, problems.withColumn("detail", detail)

    _, weather = source("weather", stg_weather, "iata_code", "observed_at", "minute", cfg.weather_stale_minutes,
                        in_hours, "weather age is unknown: no usable reading time",
                        f"weather is %s stale (expected under {hours:g}h)", "weather stale for ")
    landing, flights = source("flights", files, "iata_code", "pulled_at", "hour", cfg.flights_stale_hours, plain,
                              "flights age is unknown: no file key can be read",
                              f"flights are %s stale (expected under {cfg.flights_stale_hours}h)",
                              "flights stale for ")
    arrivals = newest_age(fact, "arrival_actual_utc", as_of, "hour").where(landing).where(
        F.col("age").isNull() | (F.col("age") > cfg.flights_stale_hours)
    ).select(F.lit("arrivals").alias("source"), F.lit(None).cast("string").alias("member"), "age",
             F.when(F.col("age").isNull(), F.lit("the fact table has no arrivals")).otherwise(
                 F.concat(F.lit("no new arrivals for "), plain(F.col("age")), F.lit(" although files are landing"))
             ).alias("detail"))
    return weather.unionByName(flights).unionByName(arrivals)


def freshness_text(problems: DataFrame, as_of: Column) -> DataFrame:
    """J3. One check result for the alert throttle: all problems in one line, NULL when there is none.

    Problems number at most two per member of the scope dimension plus three.
    """
    lines = F.sort_array(F.collect_list("detail"))
    return problems.agg(F.nullif(F.array_join(lines, "; "), F.lit("")).alias("detail")).select(
        F.lit("freshness").alias("check"), as_of.alias("checked_at"), "detail")


def carry_result(ticks: DataFrame, results: DataFrame, key: str = "check", at: str = "checked_at",
                 value: str = "detail") -> DataFrame:
    """J7. For every tick, the result of the latest check at or before it, as if it had just run."""
    return asof_join(ticks, results.withColumnRenamed(at, "result_at"), [key], at, "result_at", [value])


def problem_signature(detail: Column | str) -> Column:
    """J6. A problem's wording without its ages, so that only a real change counts as news."""
    text = F.col(detail) if isinstance(detail, str) else detail
    return F.regexp_replace(text, r"\d+(\.\d+)?h\b", "Nh")
