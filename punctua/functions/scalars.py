"""Scalar column functions. All compile to JVM expressions; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from punctua import config

__all__ = [
    "age", "batch_date", "batch_id", "bin_right_closed", "capture", "carrier_code", "clean_name",
    "datediff_boundary", "delay_minutes", "epoch_utc", "event_key", "file_airport", "file_pulled_at",
    "first_known", "has_keyword", "hours_between", "late_at", "map_values", "merge_livery", "outside",
    "rounded_int", "safe_number", "safe_rate", "staleness_bucket", "time_of_day", "time_of_day_order",
    "title_case", "to_double", "wall_time", "flag", "rate_of",
]

# The characters after which a title-cased word starts anew.
_WORD_BREAKS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- parsing ---------------------------------------------------------------

def wall_time(text: Column | str) -> Column:
    """B4. Text to a wall-clock timestamp; a trailing UTC offset is dropped, not applied."""
    return _col(text).try_cast("timestamp_ntz")


def epoch_utc(seconds: Column | str) -> Column:
    """B5. Epoch seconds to a UTC wall-clock timestamp, whatever the session zone."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=_col(seconds).cast("decimal(18,6)")
    )


def safe_number(text: Column | str) -> Column:
    """B6. Whole number or NULL; fractions round half up."""
    return _col(text).try_cast("decimal(38,0)")


def rounded_int(number: Column | str) -> Column:
    """Round to an integer instead of truncating."""
    return F.round(_col(number)).cast("int")


def capture(text: Column | str, pattern: str, group: int = 1) -> Column:
    """B12. First regex capture, NULL when nothing matches."""
    return F.nullif(F.regexp_extract(_col(text), pattern, group), F.lit(""))


def file_airport(source_file: Column | str) -> Column:
    """A7. Airport code in a landed file's key, NULL for keys without one."""
    return capture(source_file, config.FILE_AIRPORT)


def file_pulled_at(source_file: Column | str) -> Column:
    """A7. When the file was pulled. The time stands right after the airport code."""
    stamp = F.concat_ws(" ", capture(source_file, config.FILE_DATE), capture(source_file, config.FILE_TIME))
    return F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HHmmss")).cast("timestamp_ntz")


# ---- names -----------------------------------------------------------------

def title_case(text: Column | str) -> Column:
    """B8. Title case that also restarts after punctuation: ``(oneworld`` -> ``(Oneworld``."""
    word, gap = f"[^{_WORD_BREAKS}]+", f"[{_WORD_BREAKS}]+"
    parts = F.regexp_extract_all(F.lower(_col(text)), F.lit(f"({word}|{gap})"), F.lit(1))
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substring(p, 2, 2**31 - 1))), ""
    )


def clean_name(name: Column | str, placeholder: str = config.DEFAULTS.name_placeholder,
               default: str = config.DEFAULTS.name_default) -> Column:
    """B9. Placeholder to NULL, title case, NULL to the default."""
    return F.coalesce(title_case(F.nullif(F.lower(_col(name)), F.lit(placeholder))), F.lit(default))


def first_known(*cols: Column | str) -> Column:
    """B10. First identity that is present."""
    return F.coalesce(*[_col(c) for c in cols])


def carrier_code(codeshare_flight: Column | str, codeshare_airline: Column | str, airline_iata: Column | str,
                 airline_icao: Column | str, flight_iata: Column | str, flight_icao: Column | str) -> Column:
    """B11. Code of the operating carrier; a codeshared row never falls back to its own airline."""
    shared = F.coalesce(_col(codeshare_airline), F.left(_col(codeshare_flight), F.lit(2)))
    own = F.coalesce(_col(airline_iata), _col(airline_icao), F.left(_col(flight_iata), F.lit(2)),
                     F.left(_col(flight_icao), F.lit(3)))
    return F.when(_col(codeshare_flight).isNotNull(), shared).otherwise(own)


def merge_livery(name: Column | str, anchored: bool = False) -> Column:
    """B13. Drop a bracketed suffix: any bracket, or (anchored) only one that ends in "Livery"."""
    return F.regexp_replace(_col(name), config.LIVERY_BRACKET if anchored else config.ANY_BRACKET, "")


def has_keyword(name: Column | str, words: str | Iterable[str]) -> Column:
    """B14. Case-insensitive alternation; a NULL name has no keyword."""
    pattern = words if isinstance(words, str) else "|".join(words)
    return F.coalesce(_col(name).rlike(f"(?i)(?:{pattern})"), F.lit(False))


def event_key(designator: Column | str, at: Column | str) -> Column:
    """B15. Text key with milliseconds, independent of session formats."""
    return F.concat(_col(designator), F.lit("_"), F.date_format(_col(at), "yyyy-MM-dd HH:mm:ss.SSS"))


def batch_id(day: Column | str, place: Column | str) -> Column:
    """B35. One pull at one place."""
    return F.concat(F.date_format(_col(day), "yyyy-MM-dd"), F.lit(" "), _col(place))


# ---- time ------------------------------------------------------------------

def datediff_boundary(unit: str, start: Column | str, end: Column | str) -> Column:
    """B16. Unit boundaries crossed between two wall times (10:00:59 to 10:01:00 is 1 minute)."""
    span = _UNIT_SECONDS[unit]

    def tick(c: Column | str) -> Column:
        seconds = F.unix_seconds(_col(c).cast("timestamp"))
        return seconds if span == 1 else F.floor(seconds / F.lit(span))

    return tick(end) - tick(start)


def age(unit: str, at: Column | str, as_of: Column) -> Column:
    """B34. Age of an instant at ``as_of``, both UTC wall times."""
    return datediff_boundary(unit, at, as_of)


def delay_minutes(sched_utc: Column | str, actual_utc: Column | str, sched_local: Column | str,
                  actual_local: Column | str) -> Column:
    """B20. Difference of the true instants, else of the wall times at the same place."""
    return F.coalesce(datediff_boundary("minute", sched_utc, actual_utc),
                      datediff_boundary("minute", sched_local, actual_local))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """B28. Elapsed hours with fractions."""
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
    return micros / F.lit(3.6e9)


def batch_date(at: Column | str, shift_hours: int = config.DEFAULTS.batch_shift_hours) -> Column:
    """B27. The day of the pull that collected an event: its time moved on by a fixed shift."""
    return (_col(at) + F.make_dt_interval(hours=F.lit(shift_hours))).cast("date")


def time_of_day(hour: Column | str, labels: Sequence[str] = config.TIME_OF_DAY_LABELS) -> Column:
    """B25. Four half-open six-hour bins; hours outside 0-23 give NULL."""
    h = _col(hour)
    out = F.when((h >= 0) & (h < 6), F.lit(labels[0]))
    for i in (1, 2, 3):
        out = out.when((h >= 6 * i) & (h < 6 * (i + 1)), F.lit(labels[i]))
    return out


def time_of_day_order(label: Column | str, labels: Sequence[str] = config.TIME_OF_DAY_LABELS) -> Column:
    """Position of a time-of-day label, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), _col(label)).cast("int") - F.lit(1)


def bin_right_closed(value: Column | str, edges: Sequence[float]) -> Column:
    """B26. Label of the interval ``(a, b]`` holding the value, NULL outside all of them."""
    v, out = _col(value), F.lit(None).cast("string")
    for lo, hi in reversed(list(zip(edges, edges[1:]))):
        out = F.when((v > lo) & (v <= hi), F.lit(f"({lo}, {hi}]")).otherwise(out)
    return out


# ---- numbers and flags -----------------------------------------------------

def flag(condition: Column) -> Column:
    """A condition as a two-valued flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def outside(value: Column | str, low, high) -> Column:
    """C3. NOT BETWEEN. Stays NULL for a NULL value, so it never fails a range rule."""
    return ~_col(value).between(low, high)


def safe_rate(part: Column, whole: Column, digits: int | None = 1, scale: float = 100.0) -> Column:
    """B37. Rounded share in percent, NULL when the whole is zero."""
    rate = F.lit(scale) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return rate if digits is None else F.round(rate, digits)


def rate_of(condition: Column, among: Column | None = None, digits: int | None = 1) -> Column:
    """Aggregate: share of rows where the condition holds, optionally among some rows only."""
    if among is None:
        return safe_rate(F.count_if(condition), F.count(F.lit(1)), digits)
    return safe_rate(F.count_if(condition & among), F.count_if(among), digits)


def staleness_bucket(lag: Column | str, matched: Column | str,
                     labels: Sequence[str] = config.STALENESS_LABELS) -> Column:
    """B32. Keys off the match flag, so it never repeats the threshold."""
    lag = _col(lag)
    return (F.when(~_col(matched), labels[3]).when(lag <= 30, labels[0])
            .when(lag <= 60, labels[1]).otherwise(labels[2]))


def late_at(delay: Column | str, threshold: int, group: Column | None = None,
            group_threshold: int | None = None) -> Column:
    """B33. Lateness with a threshold that may differ for one group. NULL delay is not late."""
    cut = F.lit(threshold)
    if group is not None and group_threshold is not None:
        cut = F.when(group, F.lit(group_threshold)).otherwise(cut)
    return flag(_col(delay) >= cut)


def map_values(value: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """B29. Look up a small fixed mapping, with a default."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, _col(value)), F.lit(default))


def to_double(df: DataFrame) -> DataFrame:
    """B36. Every decimal column as double."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])
