"""Aggregates, reports, quality checks, freshness and loading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.catalog import derived
from punctua.catalog.derived import STAGING_SQL, fact_sql
from punctua.catalog.registry import Tables, query
from punctua.functions import rate_of
from punctua.operators import (busiest, correlation, crosstab, daily_average, data_summary, dense_histogram,
                               group_sizes, join_ranked, last_days, missing_counts, one_row, pivot_stat, quantiles,
                               rate_by, slice_counts, tail_counts, threshold_flags, top_k, with_and_without)
from punctua.plans import (ScanCheck, age_per_member, all_checks, average_delays, carry_result, condition_by_airport,
                           freshness_problems, label_histogram, late_rate, leaderboard, newest_age, overview,
                           pipeline_counts, prepare, publish_checked, run_checks, scope_share, staleness_histogram, throttle_alerts,
                           weather_coverage)
from punctua.session import shared_dir
from punctua.sources import CommitLog, fingerprint, load_new_files, load_report, load_totals, usage_budget

# ---- reports over the fact ----------------------------------------------------


@query("report_overview", fact_sql("""
select count(*) as flights, count_if(has_suspect_times) as suspect,
  round(100.0 * count_if(is_delayed_arrival and not has_suspect_times) / nullif(count_if(not has_suspect_times), 0), 1)
    as pct_late,
  round(100.0 * count_if(has_weather_match) / nullif(count(*), 0), 1) as pct_weather,
  round(avg(case when not has_suspect_times then minutes_recovered end), 1) as avg_recovered from fact"""))
def report_overview(t: Tables) -> DataFrame:
    """E1, C4."""
    return overview(derived.fact_table(t))


@query("report_late_rate", fact_sql("""
select arrival_airport, count(*) as flights, round(100.0 * count_if(is_delayed_arrival) / count(*), 1) as pct_late
from fact where not has_suspect_times group by 1"""))
def report_late_rate(t: Tables) -> DataFrame:
    """E2."""
    return late_rate(derived.fact_table(t))


@query("report_average_delays", fact_sql("""
select arrival_airport, round(avg(departure_delay_minutes), 1) as avg_dep, round(avg(arrival_delay_minutes), 1) as avg_arr,
  count(*) as flights from fact where not has_suspect_times group by 1"""))
def report_average_delays(t: Tables) -> DataFrame:
    """E3."""
    return average_delays(derived.fact_table(t))


@query("report_leaderboard", fact_sql("""
,
per as (
  select regexp_replace(operating_carrier_name, ' *[(][^)]*Livery[)]$', '') as carrier,
    list(arrival_delay_minutes) as delays, list(is_delayed_arrival::int) as late from fact where not has_suspect_times group by all),
shares as (select carrier, len(late) as flights, round(list_avg(delays), 1) as avg_arr_delay, round(100.0 * list_sum(late) / len(late), 1) as pct_late from per)
from shares where flights >= 5 qualify row_number() over (order by pct_late desc, carrier) <= 15"""))
def report_leaderboard(t: Tables) -> DataFrame:
    """E4, B13, G1."""
    return leaderboard(derived.fact_table(t))


@query("report_scope_share", fact_sql("""
select round(100.0 * count_if(departure_airport in (select iata_code from dim_airports)) / nullif(count(*), 0), 0) as pct
from fact"""))
def report_scope_share(t: Tables) -> DataFrame:
    """E5."""
    return scope_share(derived.fact_table(t), derived.airports(t))


@query("report_conditions", fact_sql(""",
trusted as (from fact where has_weather_match and not has_suspect_times and weather_main is not null),
top as (select list(weather_main order by n desc, weather_main)[:3] as names from (select weather_main, count(*) as n from trusted group by all)),
placed as (select arrival_airport as airport, arrival_delay_minutes, weather_main, list_position(names, weather_main) as place from trusted, top)
select airport, if(place is null, 'Other', weather_main) as condition, coalesce(place, 4)::int as rank, count(*) as flights,
  round(avg(arrival_delay_minutes), 1) as avg_arr_delay from placed group by all"""))
def report_conditions(t: Tables) -> DataFrame:
    """E6, D4, F4."""
    return condition_by_airport(derived.fact_table(t))


@query("report_weather_coverage", fact_sql(
    "select count(*) as n, count_if(has_weather_match) as matched from fact"))
def report_weather_coverage(t: Tables) -> DataFrame:
    """E6."""
    return weather_coverage(derived.fact_table(t))


@query("report_label_histogram", fact_sql(
    "select marketing_label_count as labels, count(*) as flights from fact group by 1"))
def report_label_histogram(t: Tables) -> DataFrame:
    """E7."""
    return label_histogram(derived.fact_table(t))


@query("report_staleness", fact_sql("""
,
classes(bucket, low, high) as (values ('a. 0-30 min', -1000000, 30), ('b. 31-60 min', 30, 60), ('c. 61 min to threshold', 60, 120),
  ('d. too stale, discarded', 120, 1000000000))
select bucket, count(*) as flights from fact join classes on weather_lag_minutes > low and weather_lag_minutes <= high group by bucket"""))
def report_staleness(t: Tables) -> DataFrame:
    """E8, B32."""
    return staleness_histogram(derived.fact_table(t))


@query("report_pipeline_counts", fact_sql("""
select *, staged_rows - physical_flights as collapsed from (
  select (select count(*) from typed) as flight_files, (select count(*) from readings) as weather_files,
    (select count(*) from stg_flights) as staged_rows, (select count(*) from fact) as physical_flights,
    (select max(observed_at) from stg_weather) as last_weather)"""))
def report_pipeline_counts(t: Tables) -> DataFrame:
    """E9, D7."""
    return pipeline_counts(derived.raw_flights(t), derived.raw_weather(t), derived.flights_table(t),
                           derived.weather_table(t), derived.fact_table(t))


@query("analysis_columns", fact_sql("""
select flight_event_key, hour(arrival_scheduled_local) as arrival_hour,
  case when hour(arrival_scheduled_local) < 6 then 'night (0-5)' when hour(arrival_scheduled_local) < 12 then 'morning (6-11)'
    when hour(arrival_scheduled_local) < 18 then 'afternoon (12-17)' else 'evening (18-23)' end as time_of_day,
  trim(regexp_replace(operating_carrier_name, '\\s*\\(.*\\)', '')) as carrier,
  (arrival_actual_utc + interval 15 hour)::date as pull_date,
  (epoch_us((arrival_actual_utc + interval 15 hour)::date::timestamp + interval 9 hour)
    - epoch_us(arrival_scheduled_utc)) / 3.6e9 as hours_before_pull,
  (epoch_us(arrival_scheduled_utc) - epoch_us(departure_scheduled_utc)) / 3.6e9 as scheduled_duration_hours
from fact where not has_suspect_times"""))
def analysis_columns(t: Tables) -> DataFrame:
    """B13, B25, B27, B28, C4. The columns every analysis starts from."""
    return prepare(derived.fact_table(t)).select(
        "flight_event_key", "arrival_hour", "time_of_day", "carrier", "pull_date", "hours_before_pull",
        "scheduled_duration_hours")


# ---- aggregates over the star schema -------------------------------------------


@query("label_crosstab", """
select event_type, count_if(dow = 0) as d0, count_if(dow = 1) as d1, count_if(dow = 2) as d2, count_if(dow = 3) as d3,
  count_if(dow = 4) as d4, count_if(dow = 5) as d5, count_if(dow = 6) as d6
from (select event_type, dayofweek(ts) as dow from events) group by 1""")
def label_crosstab(t: Tables) -> DataFrame:
    """E11. Counts with fixed columns."""
    days = t.events.select("event_type", (F.dayofweek("ts") - 1).alias("dow"))
    return crosstab(days, "event_type", "dow", range(7), names=[f"d{i}" for i in range(7)])


@query("share_crosstab", """
select l_returnflag, round(count_if(l_linestatus = 'F') / count(*)::double, 4) as finished,
  round(count_if(l_linestatus = 'O') / count(*)::double, 4) as open from lineitem group by 1""")
def share_crosstab(t: Tables) -> DataFrame:
    """E11. Row shares."""
    return crosstab(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O"], normalize=True,
                    names=["finished", "open"], digits=4)


@query("pivot_mean", """
select c_mktsegment, case when count_if(p = '1') >= 30 then round(avg(b) filter (where p = '1'), 9) end as urgent,
  case when count_if(p = '5') >= 30 then round(avg(b) filter (where p = '5'), 9) end as low
from (select c_mktsegment, left(o_orderpriority, 1) as p, o_totalprice as b from orders
  join customer on o_custkey = c_custkey) group by 1""")
def pivot_mean(t: Tables) -> DataFrame:
    """E12. Means per cell, thin cells blank."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_mktsegment", F.left("o_orderpriority", F.lit(1)).alias("p"), "o_totalprice")
    cells = pivot_stat(rows, "c_mktsegment", "p", "o_totalprice", ["1", "5"], "mean", 30, ["urgent", "low"])
    return cells.withColumns({c: F.round(c, 9) for c in ("urgent", "low")})


@query("pivot_median", """
select event_type, case when count_if(high) >= 30 then round(quantile_cont(value, 0.5) filter (where high), 9) end as high,
  case when count_if(not high) >= 30 then round(quantile_cont(value, 0.5) filter (where not high), 9) end as low
from (select event_type, value, user_id > 75 as high from events) group by 1""")
def pivot_median(t: Tables) -> DataFrame:
    """E12. Medians per cell."""
    rows = t.events.select("event_type", "value", (F.col("user_id") > 75).alias("high"))
    cells = pivot_stat(rows, "event_type", "high", "value", [True, False], "median", 30, ["high", "low"])
    return cells.withColumns({c: F.round(c, 9) for c in ("high", "low")})


@query("slot_comparison", """
select slot, round(avg(v) filter (where sfo), 6) as rate_group, round(avg(v) filter (where not sfo), 6) as rate_rest,
  count_if(sfo)::bigint as n_group, count_if(not sfo)::bigint as n_rest
from (select hour(ts) // 6 as slot, event_type = 'error' as sfo, case when value > 100 then 1.0 else 0.0 end as v
  from events) group by 1""")
def slot_comparison(t: Tables) -> DataFrame:
    """L21, E12. One group against the rest within each time slot."""
    rows = t.events.select(F.floor(F.hour("ts") / 6).alias("slot"), (F.col("event_type") == "error").alias("sfo"),
                           F.when(F.col("value") > 100, 1.0).otherwise(0.0).alias("v"))
    names = ["rate_group", "rate_rest"]
    rates = pivot_stat(rows, "slot", "sfo", "v", [True, False], "mean", names=names)
    sizes = pivot_stat(rows, "slot", "sfo", "v", [True, False], "count", names=["n_group", "n_rest"])
    return rates.join(sizes, "slot").withColumns({c: F.round(c, 6) for c in names})


@query("event_quantiles", """
select event_type, round(quantile_cont(value, 0.025), 9) as q025, round(quantile_cont(value, 0.5), 9) as median,
  round(quantile_cont(value, 0.975), 9) as q975 from events group by 1""")
def event_quantiles(t: Tables) -> DataFrame:
    """E13. Exact quantiles, interpolated."""
    out = quantiles(t.events, "value", [0.025, 0.5, 0.975], ["event_type"], ["q025", "median", "q975"])
    return out.withColumns({c: F.round(c, 9) for c in ("q025", "median", "q975")})


@query("price_median", """
select round(quantile_cont(l_extendedprice, 0.5), 9) as median_price,
  round(corr(case when l_returnflag <> 'N' then l_quantity end, l_extendedprice), 6) as correlation from lineitem""")
def price_median(t: Tables) -> DataFrame:
    """E13, E14. A median over all rows, and a correlation over the pairs that exist."""
    paired = t.lineitem.select(F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("q"), "l_extendedprice")
    return one_row(quantiles(t.lineitem, "l_extendedprice", [0.5], names=["median_price"]),
                   correlation(paired, "q", "l_extendedprice")).withColumns(
        {"median_price": F.round("median_price", 9), "correlation": F.round("correlation", 6)})


@query("busiest_day", """
select ts::date as day, count(*) as events, round(count(*) / (select count(*) from events)::double, 6) as share
from events group by 1 order by events desc, day limit 1""")
def busiest_day(t: Tables) -> DataFrame:
    """E16."""
    days = t.events.select(F.col("ts").cast("date").alias("day"))
    return busiest(days, "day", "events").withColumn("share", F.round("share", 6))


@query("with_and_without", """
with top as (select ts::date as day from events group by 1 order by count(*) desc, day limit 1)
select event_type, round(avg(h), 6) as rate_all,
  round(avg(h) filter (where ts::date <> (select day from top)), 6) as rate_without_busiest
from (select event_type, ts, case when value > 50 then 1.0 else 0.0 end as h from events) group by 1""")
def with_without(t: Tables) -> DataFrame:
    """E16. Rates with and without the busiest day."""
    rows = t.events.select("event_type", F.col("ts").cast("date").alias("day"), (F.col("value") > 50).alias("high"))
    return with_and_without(rows, "event_type", "high", "day").withColumns(
        {c: F.round(c, 6) for c in ("rate_all", "rate_without_busiest")})


@query("dense_hours", """
select h.h as hour, coalesce(n, 0) as events from range(0, 24) h(h)
left join (select hour(ts) as h, count(*) as n from events where value > 300 group by 1) e using (h)""")
def dense_hours(t: Tables) -> DataFrame:
    """E17. Every hour, zero where nothing falls."""
    return dense_histogram(t.events.where("value > 300"), F.hour("ts"), 0, 23, "events", "hour")


@query("group_sizes", """
select user_id, count(*) as batches, min(n) as smallest, max(n) as largest
from (select user_id, ts::date as day, count(*) as n from events group by 1, 2) group by 1""")
def group_sizes_query(t: Tables) -> DataFrame:
    """E18. Batches per group, and their sizes."""
    return group_sizes(t.events.select("user_id", F.col("ts").cast("date").alias("day")), "user_id", "day")


@query("missing_counts", """
select 'l_quantity' as "column", count_if(l_quantity > 45) as missing from lineitem
union all select 'l_tax', count_if(l_tax > 0.07) from lineitem union all select 'l_partkey', 0 from (select 1)""")
def missing_counts_query(t: Tables) -> DataFrame:
    """E19. Missing values per column in one scan."""
    rows = t.lineitem.select(F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("l_quantity"),
                             F.when(F.col("l_tax") <= 0.07, F.col("l_tax")).alias("l_tax"), "l_partkey")
    return missing_counts(rows, ["l_quantity", "l_tax", "l_partkey"])


@query("data_summary", """
select count(*) as events, min(ts)::date as first_day, max(ts)::date as last_day, count(distinct ts::date) as days,
  count_if(event_type = 'error') as errors, round(100.0 * count_if(value > 100) / count(*), 1) as pct_high from events""")
def data_summary_query(t: Tables) -> DataFrame:
    """E20. A one-row card."""
    day = F.col("ts").cast("date")
    return data_summary(t.events, events=F.count(F.lit(1)), first_day=F.min(day), last_day=F.max(day),
                        days=F.count_distinct(day), errors=F.count_if(F.col("event_type") == "error"),
                        pct_high=rate_of(F.col("value") > 100))


@query("daily_average", """
select event_type, ts::date as day, round(avg(value), 9) as avg_value from events group by 1, 2 having avg(value) < 45""")
def daily_average_query(t: Tables) -> DataFrame:
    """E21, C8. Daily averages under a limit."""
    return daily_average(t.events, "event_type", "ts", "value", "avg_value", F.col("avg_value") < 45).withColumn(
        "avg_value", F.round("avg_value", 9))


@query("tail_counts", """
select event_type, count(value) as rows, count_if(value >= 150) as beyond_cut, max(value) as largest
from events group by 1""")
def tail_counts_query(t: Tables) -> DataFrame:
    """E22."""
    return tail_counts(t.events, "event_type", "value", 150)


@query("slice_counts", """
select l_returnflag, l_linestatus, count(*) as rows from lineitem where l_quantity < 10 group by 1, 2""")
def slice_counts_query(t: Tables) -> DataFrame:
    """E23. Counts inside a slice."""
    return slice_counts(t.lineitem, F.col("l_quantity") < 10, ["l_returnflag", "l_linestatus"])


@query("rates_by_segment", """
select c_mktsegment, count(*) as rows, count_if(o_orderstatus = 'F') as late,
  round(count_if(o_orderstatus = 'F') / count(*)::double, 6) as late_rate
from orders join customer on o_custkey = c_custkey group by 1""")
def rates_by_segment(t: Tables) -> DataFrame:
    """E10."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rate_by(rows, ["c_mktsegment"], F.col("o_orderstatus") == "F").withColumn(
        "late_rate", F.round("late_rate", 6))


@query("customer_leaderboard", """
select c_custkey, count(*) as orders, round(avg(o_totalprice), 9) as avg_price from orders
join customer on o_custkey = c_custkey group by 1 having count(*) >= 5 order by orders desc, c_custkey limit 15""")
def customer_leaderboard(t: Tables) -> DataFrame:
    """E4, C8, G1. Top k of groups big enough."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("o_totalprice"), 9).alias("avg_price"))
    known = per.join(t.customer.select("c_custkey"), "c_custkey", "left_semi").where("orders >= 5")
    return top_k(known, [F.desc("orders"), F.asc("c_custkey")], 15)


@query("folded_categories", """
with ranked as (select event_type, row_number() over (order by count(*) desc, event_type) as rn from events group by 1)
select user_id, case when rn <= 3 then event_type else 'Other' end as category, least(min(rn), 4)::int as rank,
  count(*) as events, round(avg(value), 9) as avg_value from events join ranked using (event_type) group by 1, 2""")
def folded_categories(t: Tables) -> DataFrame:
    """E6, D4, F4. Rare categories fold before averaging."""
    ranked = join_ranked(t.events, "event_type", 3)
    name = F.when(F.col("rank") <= 3, F.col("event_type")).otherwise(F.lit("Other"))
    return ranked.groupBy("user_id", name.alias("category")).agg(
        F.min("rank").alias("rank"), F.count(F.lit(1)).alias("events"), F.round(F.avg("value"), 9).alias("avg_value"))


@query("threshold_flags", """
select coalesce(visibility >= 10000, false) as visibility_capped, coalesce(visibility < 5000, false) as low_visibility,
  gust is not null as gust_reported, count(*) as rows
from (select case when l_returnflag <> 'A' then (l_partkey * 10) % 12000 end as visibility,
    case when l_linestatus = 'F' then l_tax end as gust from lineitem) group by 1, 2, 3""")
def threshold_flags_query(t: Tables) -> DataFrame:
    """B30. An unknown value is neither capped nor low."""
    rows = t.lineitem.select(
        F.when(F.col("l_returnflag") != "A", (F.col("l_partkey") * 10) % 12000).alias("weather_visibility_m"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("weather_wind_gust"))
    return slice_counts(threshold_flags(rows), F.lit(True), ["visibility_capped", "low_visibility", "gust_reported"])


@query("relative_window", """
select event_type, count(*) as events, count_if(value > 50) as matched from events
where ts >= (select max(ts) from events) - interval 7 day group by 1 having count(*) >= 20""")
def relative_window(t: Tables) -> DataFrame:
    """C6, H14. The last seven days of the table itself."""
    return last_days(t.events, "ts", 7).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("value") > 50).alias("matched")).where("events >= 20")


# ---- quality, freshness, loading -----------------------------------------------

def _checks_sql(only: set[str] | None = None) -> str:
    """All 48 checks over the same tables, one SELECT each."""
    scoped = ("(select * from stg_flights where arrival_airport in (select iata_code from dim_airports)) s")
    rows: list[tuple[str, str, str]] = []

    def scan(name: str, table: str, condition: str, severity: str = "error") -> None:
        rows.append((name, severity, f"select count_if({condition}) from {table}"))

    for table, cols in {
        "stg_flights": ["flight_status", "arrival_airport", "departure_scheduled_local", "flight_date",
                        "has_dst_ambiguous_time", "source_file"],
        "stg_weather": ["observed_at", "temp_f", "weather_main", "source_file"],
        "dim_airports": ["iata_code", "latitude", "longitude"],
        "fact": ["flight_event_key", "operating_flight_iata", "operating_carrier_code", "operating_carrier_name",
                 "marketing_label_count", "arrival_airport", "departure_scheduled_local", "is_delayed_departure",
                 "is_delayed_arrival", "has_suspect_times", "has_retimed_arrival_schedule", "has_dst_ambiguous_time",
                 "has_weather_match"],
    }.items():
        for c in cols:
            scan(f"not_null_{table}_{c}", table, f"{c} is null")
    scan("accepted_values_stg_flights_flight_status", "stg_flights", "flight_status not in ('landed')")
    scan("airport_coordinates_plausible", "dim_airports",
         "latitude not between 24 and 50 or longitude not between -125 and -66")
    scan("arrival_after_departure", "fact", "not has_dst_ambiguous_time and (arrival_actual_utc < departure_actual_utc"
         " or arrival_scheduled_utc < departure_scheduled_utc)")
    scan("delay_minutes_realistic", "fact", "not has_suspect_times and (departure_delay_minutes not between -240 and"
         " 1440 or arrival_delay_minutes not between -240 and 1440)")
    scan("weather_lag_within_threshold", "fact", "(has_weather_match and weather_lag_minutes > 120) or"
         " (not has_weather_match and weather_main is not null) or weather_lag_minutes < 0")
    scan("weather_units_sane", "fact", "has_weather_match and (weather_temp_f not between -60 and 140 or"
         " weather_humidity not between 0 and 100 or weather_cloud_cover_pct not between 0 and 100)")

    def whole(name: str, condition: str, table: str = "fact", severity: str = "error") -> None:
        rows.append((name, severity, f"select case when {condition} then 1 else 0 end from {table}"))

    whole("delay_present_for_landed", "count(*) > 0 and (count_if(arrival_delay_minutes is null) > count(*) * 0.05 or"
          " count_if(departure_delay_minutes is null) > count(*) * 0.05)")
    whole("fact_table_not_empty", "count(*) = 0 or count_if(has_weather_match) = 0")
    whole("missing_timezone_rate", "count_if(departure_timezone is null or arrival_timezone is null) > 0.03 * count(*)")
    whole("suspect_time_rate", "count_if(has_suspect_times) > 5 and count_if(has_suspect_times) > 0.01 * count(*)")
    whole("arrival_ceiling_unchanged", "max(arrival_delay_minutes) filter (where not has_suspect_times) > 60",
          severity="warn")
    whole("unidentified_flight_rate",
          "count_if(coalesce(codeshare_flight_iata, flight_iata, flight_icao) is null) > 0.01 * count(*)", scoped)

    def rowset(name: str, body: str, severity: str = "error") -> None:
        rows.append((name, severity, f"select count(*) from ({body})"))

    rowset("unique_fact_flight_event_key", "select 1 from fact group by flight_event_key having count(*) > 1")
    rowset("unique_dim_airports_iata_code", "select 1 from dim_airports group by iata_code having count(*) > 1")
    for child, col in (("fact", "arrival_airport"), ("stg_weather", "iata_code")):
        rowset(f"relationships_{child}_{col}", f"select 1 from {child} where {col} is not null and {col} not in "
               "(select iata_code from dim_airports)")
    keys = " union all ".join(
        f"select '{kind}' as k, coalesce({cols}) as d, departure_scheduled_local as s, departure_airport as a,"
        f" arrival_airport as b from {scoped} where coalesce(codeshare_flight_iata, flight_iata, flight_icao) is not null"
        for kind, cols in (("operating", "codeshare_flight_iata, flight_iata, flight_icao"),
                           ("marketing", "flight_iata, flight_icao")))
    rowset("grain_key_single_route", f"select 1 from ({keys}) group by k, d, s having count(distinct (a, b)) > 1")
    rowset("no_case_split_grain", "select 1 from fact group by upper(operating_flight_iata), departure_scheduled_local"
           " having count(distinct operating_flight_iata) > 1")
    rowset("weather_coverage_per_airport", "select 1 from fact where arrival_actual_utc >= (select"
           " max(arrival_actual_utc) from fact) - interval 7 day group by arrival_airport"
           " having count(*) >= 20 and avg(case when has_weather_match then 1 else 0 end) < 0.5")
    rowset("weather_fresh_per_airport", "select 1 from dim_airports a left join stg_weather w using (iata_code)"
           " group by a.iata_code having max(observed_at) is null or max(observed_at) <"
           " (select max(observed_at) from stg_weather) - interval 6 hour", "warn")
    rowset("weather_temp_is_fahrenheit", "select 1 from stg_weather where iata_code in ('MIA', 'LAX')"
           " group by iata_code, observed_at::date having avg(temp_f) < 40")
    rows.append(("actual_is_runway_time", "warn", "select count_if(l_quantity = 13) from label_rows"))
    return " union all ".join(
        f"select '{n}' as \"check\", '{s}' as severity, ({q})::bigint as violations, ({q}) = 0 as passed"
        for n, s, q in rows if n in (only or {r[0] for r in rows}))


@query("quality_suite", fact_sql(_checks_sql()))
def quality_suite(t: Tables) -> DataFrame:
    """H1-H22. All 48 checks as one result table."""
    tables = {"raw_flights": derived.raw_flights(t), "stg_flights": derived.flights_table(t),
              "stg_weather": derived.weather_table(t), "dim_airports": derived.airports(t),
              "fact": derived.fact_table(t)}
    return run_checks(tables, all_checks())


_CHECKED = {"stg_flights": derived.staged_flights, "stg_weather": derived.staged_weather, "fact": lambda t: derived.fact(t, at_schedule=True)}


def _scans(table: str) -> set[str]:
    return {c.name for c in all_checks() if isinstance(c, ScanCheck) and c.table == table}


@query("checked_publish", fact_sql("select *, bool_and(passed or severity = 'warn') over (partition by \"table\") as published from ("
       + " union all ".join(f"select '{name}' as \"table\", * from ({_checks_sql(_scans(name))})" for name in _CHECKED) + ")"))
def checked_publish(t: Tables) -> DataFrame:
    """H22, C9, A9. Each table written once with its scan checks observed by the write; one that fails a check of severity ``error`` is not published."""
    log, parts = CommitLog(t.spark, shared_dir(t.spark, "checked")), []
    for name, build in _CHECKED.items():
        rows, kept = derived.unwritten(t, name, lambda: build(t))
        outcomes, published = publish_checked(log, rows, name, all_checks(), kept)
        if (log.snapshot().read(name) is not None) != published:
            raise AssertionError(f"{name}: readers see what the gate did not decide")
        parts.append(outcomes.withColumns({"table": F.lit(name), "published": F.lit(published)}))
    return reduce(DataFrame.unionByName, parts)


_AS_OF = "2001-11-02 12:00:30"


@query("freshness_ages", f"""{STAGING_SQL}
select a.iata_code, date_diff('minute', max(observed_at), timestamp '{_AS_OF}') as age_minutes
from dim_airports a left join stg_weather w using (iata_code) group by 1
union all select 'overall', date_diff('minute', max(observed_at), timestamp '{_AS_OF}') from stg_weather""")
def freshness_ages(t: Tables) -> DataFrame:
    """J1, J2, B34, M5, M10. Boundary minutes since the newest reading, overall and per expected member."""
    as_of = F.expr(f"TIMESTAMP_NTZ'{_AS_OF}'")
    weather = derived.weather_table(t)
    return age_per_member(derived.airports(t), weather, "iata_code", "observed_at", as_of, name="age_minutes").unionByName(
        newest_age(weather, "observed_at", as_of, name="age_minutes").select(F.lit("overall").alias("iata_code"), "age_minutes"))


@query("freshness_problems", fact_sql(f""",
clock as (
  select nullif(regexp_extract(source_file, '/([A-Z]{{3}})_', 1), '') as iata_code,
    strptime(regexp_extract(source_file, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) || ' ' ||
             regexp_extract(source_file, '[A-Z]{{3}}_([0-9]{{6}})', 1), '%Y-%m-%d %H%M%S') as pulled_at from stg_flights),
ages as (
  select 'weather' as source, null as member, date_diff('minute', max(observed_at), timestamp '{_AS_OF}') as age, 180 as lim
  from stg_weather
  union all select 'weather', iata_code, date_diff('minute', max(observed_at), timestamp '{_AS_OF}'), 180
  from dim_airports left join stg_weather using (iata_code) group by iata_code
  union all select 'flights', null, date_diff('hour', max(pulled_at), timestamp '{_AS_OF}'), 54 from clock
  union all select 'flights', iata_code, date_diff('hour', max(pulled_at), timestamp '{_AS_OF}'), 54
  from dim_airports left join clock using (iata_code) group by iata_code
  union all select 'arrivals', null, date_diff('hour', max(arrival_actual_utc), timestamp '{_AS_OF}'), 54 from fact),
fresh as (select source, coalesce(age <= lim, false) as ok from ages where member is null)
select source, member, age::bigint as age from ages a
where (age is null or age > lim)
  and (member is null or (select ok from fresh f where f.source = a.source))
  and (source <> 'arrivals' or (select ok from fresh where source = 'flights'))"""))
def freshness_problems_query(t: Tables) -> DataFrame:
    """J1-J5. What is stale: whole sources, silent members, or arrivals that stopped while files land."""
    return freshness_problems(
        derived.airports(t), derived.weather_table(t), derived.flights_table(t), derived.fact_table(t),
        F.expr(f"TIMESTAMP_NTZ'{_AS_OF}'")).select("source", "member", "age")


_CHECKS = ("case event_type when 'error' then 'stale for 3h' when 'view' then 'stale for 7.5h' when 'click' "
           "then 'down' end")


def check_results(t: Tables) -> DataFrame:
    """A check result per event: what is wrong with one user at one time, or nothing."""
    detail = (F.when(F.col("event_type") == "error", "stale for 3h").when(F.col("event_type") == "view", "stale for 7.5h")
              .when(F.col("event_type") == "click", "down"))
    return t.events.select(F.col("user_id").cast("string").alias("check"), F.col("ts").alias("checked_at"), detail.alias("detail"))


@query("alert_throttle", f"""
with recursive results as (
  select user_id::varchar as "check", ts as checked_at, {_CHECKS} as detail from events),
numbered as (
  select *, row_number() over (partition by "check" order by checked_at, detail nulls first) as i,
    regexp_replace(detail, '\\d+(\\.\\d+)?h\\b', 'Nh') as sig from results),
walk as (
  select "check", i, checked_at, detail, sig, case when sig is not null then 'alert' end as kind,
    case when sig is not null then checked_at end as last_at, 0::bigint as held, 0::bigint as said
  from numbered where i = 1
  union all
  select n."check", n.i, n.checked_at, n.detail, n.sig,
    case when n.sig is null then case when w.sig is not null then 'recovered' end
         when w.sig is distinct from n.sig or n.checked_at > w.last_at + interval 6 hour then 'alert' end,
    case when n.sig is null then null
         when w.sig is distinct from n.sig or n.checked_at > w.last_at + interval 6 hour then n.checked_at
         else w.last_at end,
    case when n.sig is not null and w.sig is not distinct from n.sig and n.checked_at <= w.last_at + interval 6 hour
         then w.held + 1 else 0 end,
    w.held
  from walk w join numbered n on n."check" is not distinct from w."check" and n.i = w.i + 1)
select "check", kind, checked_at, detail, said as suppressed from walk where kind is not null""")
def alert_throttle(t: Tables) -> DataFrame:
    """J6. Announce a problem at once, on change, at most every 6 hours, and its end once."""
    return throttle_alerts(check_results(t))


@query("carried_results", """
with results as (select user_id, ts as result_at, case when value > 60 then event_type end as detail from events
  where event_type = 'signup'),
ticks as (select user_id, ts as checked_at from events group by 1, 2)
select t.user_id, t.checked_at, r.result_at, r.detail
from ticks t asof left join results r on t.user_id = r.user_id and t.checked_at >= r.result_at""")
def carried_results(t: Tables) -> DataFrame:
    """J7. Between two slow checks the last result still counts."""
    results = t.events.where("event_type = 'signup'").select(
        "user_id", F.col("ts").alias("checked_at"), F.when(F.col("value") > 60, F.col("event_type")).alias("detail"))
    ticks = t.events.select("user_id", F.col("ts").alias("checked_at")).distinct()
    return carry_result(ticks, results, "user_id")


@query("fact_fingerprint", fact_sql("""
, keyed as (select *, ('0x' || left(md5(flight_event_key), 15))::bigint as h from fact)
select count(*) as row_count, count(flight_event_key) as key_count, bit_xor(h) as key_xor, sum(h::hugeint)::varchar as key_sum,
  sum(arrival_delay_minutes)::bigint as delay_total, count_if(has_weather_match) as weather_rows from keyed"""))
def fact_fingerprint(t: Tables) -> DataFrame:
    """A11. The order-independent fingerprint of the fact: counts, both hashes of all keys, totals."""
    return fingerprint(derived.fact_table(t), "flight_event_key", {
        "delay_total": F.sum("arrival_delay_minutes"), "weather_rows": F.count_if("has_weather_match")})


@query("load_new_files", """
with landed as (
  select 'raw/' || o_orderkey || '.json' as source_file, o_orderstatus = 'F' as broken from orders
  union all select 'raw/' || o_orderkey || '.json', o_orderstatus = 'F' from orders where o_orderpriority = '5-LOW'),
fresh as (select distinct * from landed where source_file not in (
  select 'raw/' || o_orderkey || '.json' from orders where o_orderdate < timestamp '1997-01-01'))
select case when broken then 'LOAD_FAILED' else 'LOADED' end as status, count(*) as files,
  count_if(not broken) as rows_loaded, max(case when broken then 'not a JSON document' end) as first_error
from fresh group by 1""")
def load_new_files_query(t: Tables) -> DataFrame:
    """A2, A3. Files not loaded before, each once even if listed twice; a broken file is reported."""
    key = F.concat(F.lit("raw/"), F.col("o_orderkey").cast("string"), F.lit(".json"))
    body = F.when(F.col("o_orderstatus") == "F", F.lit("<html>")).otherwise(F.lit('{"data": []}'))
    listed = t.orders.select(body.alias("raw_data"), key.alias("source_file"))
    again = t.orders.where("o_orderpriority = '5-LOW'").select(body.alias("raw_data"), key.alias("source_file"))
    loaded = t.orders.where(F.col("o_orderdate") < "1997-01-01").select(key.alias("source_file"))
    return load_report(load_new_files(listed.unionByName(again), loaded))


@query("load_totals", """
select 'orders' as table_name, count(*) as total_files from orders union all select 'pages', count(*) from pages""")
def load_totals_query(t: Tables) -> DataFrame:
    """A4."""
    return load_totals({"orders": t.orders, "pages": t.pages})


@query("usage_budget", """
select month, used, runs_left, used + 5 > 200 as refused, 200 - used - 5 - runs_left * 5 as headroom from (
  select month, used, (select count(*) from range(month, month + interval 1 month, interval 1 day) d(d)
      where day(d) % 2 = 1 and d + interval 9 hour > timestamp '1998-06-15 09:00:00')::bigint as runs_left
  from (select date_trunc('month', o_orderdate)::date as month, count(*) as used from orders group by 1))""")
def usage_budget_query(t: Tables) -> DataFrame:
    """E24. Monthly usage, scheduled runs still to come, and the headroom after them."""
    return usage_budget(t.orders, "o_orderdate", 200, 5, F.expr("TIMESTAMP_NTZ'1998-06-15 09:00:00'"))
