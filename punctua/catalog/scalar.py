"""Column functions, filters and joins over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua import config
from punctua.catalog.derived import title_sql
from punctua.catalog.registry import Tables, query
from punctua.functions import (batch_date, batch_id, bin_right_closed, capture, clean_name, datediff_boundary,
                               delay_minutes, epoch_utc, event_key, first_known, flag, has_keyword, hours_between,
                               late_at, map_values, merge_livery, outside, safe_number,
                               time_of_day, time_of_day_order, title_case, wall_time, with_utc)
from punctua.operators import (distinct_count, in_scope, left_from_dim, missing_members, rare_to_other, union_keys,
                               unmapped_values)
from punctua.plans import flatten_records, has_retimed_schedule, has_suspect_times
from punctua.sources import payload_class


@query("json_flatten", """
select o_orderkey, name, amount from (
  select o_orderkey, 'total' as name, o_totalprice as amount from orders where o_orderstatus <> 'P'
  union all
  select o_orderkey, 'priority', left(o_orderpriority, 1)::double from orders where o_orderstatus <> 'P')""")
def json_flatten(t: Tables) -> DataFrame:
    """B1, B2, M13. Records of a nested list; documents with an empty list give no rows."""
    pair = F.array(F.struct(F.lit("total").alias("name"), F.col("o_totalprice").alias("amount")),
                   F.struct(F.lit("priority").alias("name"),
                            F.left("o_orderpriority", F.lit(1)).cast("double").alias("amount")))
    none = F.array().cast("array<struct<name:string,amount:double>>")
    raw = t.orders.select("o_orderkey", F.to_json(F.struct(
        F.when(F.col("o_orderstatus") == "P", none).otherwise(pair).alias("data"))).alias("raw_data"))
    return flatten_records(raw, "STRUCT<name: STRING, amount: DOUBLE>").select("o_orderkey", "r.name", "r.amount")


@query("json_scalar", "select event_id, (props->>'$.k')::bigint as k from events")
def json_scalar(t: Tables) -> DataFrame:
    """B2, B6. One typed value from a document."""
    return t.events.select("event_id", safe_number(F.get_json_object("props", "$.k")).cast("bigint").alias("k"))


@query("payload_classes", """
select case o_orderstatus when 'P' then 'empty' when 'F' then 'rejected' else 'accepted' end as payload_class,
  left(o_orderpriority, 1) as priority, count(*) as files from orders group by 1, 2""")
def payload_classes(t: Tables) -> DataFrame:
    """A6, M1. Which responses count: accepted, empty, or rejected (an error body or a missing list)."""
    key = F.col("o_orderkey").cast("string")
    broken = F.when(F.col("o_totalprice") > 250000, F.concat(F.lit('{"error": {"code": '), key, F.lit("}, \"data\": []}"))
                    ).otherwise(F.concat(F.lit('{"pagination": {"total": '), key, F.lit("}}")))
    body = (F.when(F.col("o_orderstatus") == "P", '{"data": []}').when(F.col("o_orderstatus") == "F", broken)
            .otherwise(F.concat(F.lit('{"data": [{"id": '), key, F.lit(', "x": null}]}'))))
    raw = t.orders.select(F.left("o_orderpriority", F.lit(1)).alias("priority"), body.alias("raw_data"))
    return raw.groupBy(payload_class("raw_data").alias("payload_class"), "priority").agg(F.count(F.lit(1)).alias("files"))


@query("offset_discard", """
select event_id, date_trunc('second', ts) as wall, date_trunc('second', ts) as from_epoch from events""")
def offset_discard(t: Tables) -> DataFrame:
    """B4, B5. A false offset is dropped; epoch seconds become UTC wall time."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))
    return t.events.select("event_id", wall_time(text).alias("wall"),
                           epoch_utc(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("from_epoch"))


@query("local_to_utc", """
with shifted as (
  select event_id, case when event_type = 'error' then null when event_type = 'view' then 'Europe/Nowhere'
      when event_type = 'click' then 'Asia/Tokyo' else 'America/New_York' end as zone,
    ts + interval 300 day as fall, ts + interval 65 day as spring from events),
marked as (
  select *, zone = 'America/New_York' and fall >= timestamp '2024-11-03 01:00:00'
      and fall < timestamp '2024-11-03 02:00:00' as fall_raw,
    zone = 'America/New_York' and spring >= timestamp '2024-03-10 02:00:00'
      and spring < timestamp '2024-03-10 03:00:00' as spring_raw,
    case when zone = 'Europe/Nowhere' then null else zone end as known from shifted)
select event_id, zone, coalesce(fall_raw, false) as fall_ambiguous, coalesce(spring_raw, false) as spring_ambiguous,
  case when not coalesce(fall_raw, false) then (fall at time zone known) at time zone 'UTC' end as fall_utc,
  case when not coalesce(spring_raw, false) then (spring at time zone known) at time zone 'UTC' end as spring_utc
from marked""")
def local_to_utc_query(t: Tables) -> DataFrame:
    """B17-B19, M3, M4. Events moved onto the two clock changes of a year."""
    zone = (F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
            .when(F.col("event_type") == "view", "Europe/Nowhere").when(F.col("event_type") == "click", "Asia/Tokyo")
            .otherwise("America/New_York"))
    moved = t.events.select("event_id", zone.alias("zone"), *[
        (F.col("ts") + F.make_dt_interval(days=F.lit(d))).alias(n) for n, d in (("fall", 300), ("spring", 65))])
    for n in ("fall", "spring"):
        moved = with_utc(moved, [("zone", n, f"{n}_utc")], f"{n}_ambiguous")
    return moved.drop("fall", "spring")


@query("delay_minutes", """
select l_orderkey, l_linenumber, l_partkey, coalesce(
    case when l_returnflag <> 'N' then date_diff('minute', a_utc, b_utc) end, date_diff('minute', a, b)) as delay,
  date_diff('hour', a, b) as hours, date_diff('day', a, b) as days
from (select *, o_orderdate + to_seconds(l_partkey % 86400) as a, l_shipdate + to_seconds((l_suppkey * 61) % 86400) as b,
    o_orderdate + to_seconds(l_partkey % 86400) - interval 9 hour as a_utc,
    l_shipdate + to_seconds((l_suppkey * 61) % 86400) - interval 9 hour as b_utc
  from lineitem join orders on l_orderkey = o_orderkey)""")
def delay_minutes_query(t: Tables) -> DataFrame:
    """B16, B20, M5. Boundaries crossed between schedule and actual; local times where no zone is known."""
    zone = F.when(F.col("l_returnflag") != "N", "Asia/Tokyo")
    timed = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", zone.alias("zone"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("l_partkey") % 86400).cast("decimal(18,6)"))).alias("a"),
        (F.col("l_shipdate") + F.make_dt_interval(secs=((F.col("l_suppkey") * 61) % 86400).cast("decimal(18,6)"))
         ).alias("b"))
    timed = with_utc(timed, [("zone", "a", "a_utc"), ("zone", "b", "b_utc")], "unclear")
    return timed.select("l_orderkey", "l_linenumber", "l_partkey",
                        delay_minutes("a_utc", "b_utc", "a", "b").alias("delay"),
                        datediff_boundary("hour", "a", "b").alias("hours"),
                        datediff_boundary("day", "a", "b").alias("days"))


@query("quality_flags", """
select l_returnflag, l_linestatus,
  count(*) as events, count_if(suspect) as suspect, count_if(retimed) as retimed, count_if(late) as late,
  count_if(late and not suspect) as late_trusted, sum(recovered)::bigint as recovered
from (select *, coalesce(dep < -180, false) or coalesce(abs(arr - dep) > 240, false) or l_tax > 0.075 as suspect,
    coalesce(dep >= 60 and abs(arr) <= 1, false) as retimed, coalesce(arr >= 15, false) as late, dep - arr as recovered
  from (select *, date_diff('day', o_orderdate, l_shipdate) as dep,
      case when l_quantity < 45 then l_quantity::bigint - 20 end as arr
    from lineitem join orders on l_orderkey = o_orderkey)) group by 1, 2""")
def quality_flags(t: Tables) -> DataFrame:
    """B21-B23, C4, M9. Flags are never NULL; suspect rows count as events, not as late."""
    dep, arr = F.col("dep"), F.col("arr")
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_returnflag", "l_linestatus", "l_tax", datediff_boundary("day", "o_orderdate", "l_shipdate").alias("dep"),
        F.when(F.col("l_quantity") < 45, F.col("l_quantity").cast("bigint") - 20).alias("arr")
    ).withColumns({"suspect": has_suspect_times(dep, arr, F.col("l_tax") > 0.075),
                   "retimed": has_retimed_schedule(dep, arr), "late": flag(arr >= 15), "recovered": dep - arr})
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("suspect").alias("suspect"), F.count_if("retimed").alias("retimed"),
        F.count_if("late").alias("late"), F.count_if(F.col("late") & ~F.col("suspect")).alias("late_trusted"),
        F.sum("recovered").alias("recovered"))


_LABEL = "p_name || ' (' || lower(p_type) || '/x&' || p_size || ' livery)'"


@query("title_case", f"""
select p_partkey, {title_sql(_LABEL)} as titled,
  coalesce({title_sql("nullif(lower(case when p_size > 40 then 'EMPTY' else p_name end), 'empty')")}, 'Unknown') as cleaned
from part""")
def title_case_query(t: Tables) -> DataFrame:
    """B8, B9, M6. Words restart after punctuation; the placeholder becomes the default."""
    label = F.concat(F.col("p_name"), F.lit(" ("), F.lower("p_type"), F.lit("/x&"), F.col("p_size").cast("string"),
                     F.lit(" livery)"))
    return t.part.select("p_partkey", title_case(label).alias("titled"),
                         clean_name(F.when(F.col("p_size") > 40, "EMPTY").otherwise(F.col("p_name"))).alias("cleaned"))


@query("regex_capture", """
select page_id, nullif(regexp_extract(url, '://([^/]+)', 1), '') as host,
  nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') as language,
  nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '')::bigint as page from pages""")
def regex_capture(t: Tables) -> DataFrame:
    """B12, A7, M12. Captures from a key; no match is NULL, not an empty text."""
    return t.pages.select("page_id", capture("url", "://([^/]+)").alias("host"),
                          capture("url", "/([a-z]{2})/").alias("language"),
                          capture("url", "[?&]page=([0-9]+)").cast("bigint").alias("page"))


@query("regex_merge", """
select p_partkey, p_name as any_bracket, case when p_size > 25 then p_name else p_name || ' (' || p_type || ')' end as anchored
from part""")
def regex_merge(t: Tables) -> DataFrame:
    """B13. Both livery rules: drop any bracket, or only one that ends in "Livery"."""
    name = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"),
                    F.when(F.col("p_size") > 25, " Livery)").otherwise(")"))
    return t.part.select("p_partkey", merge_livery(name).alias("any_bracket"),
                         merge_livery(name, anchored=True).alias("anchored"))


@query("keyword_class", """
select regexp_matches(p_name, 'ring|widget|^old', 'i') as is_cargo, regexp_matches(p_type, 'PROM|economy', 'i') as is_promo,
  regexp_matches(case when p_size > 30 then 'Fedex ' || p_name else p_name end,
    'Cargo|Fedex|Dhl|Ups|Abx Air|Atlas Air|Air Transport International|Amerijet|Kalitta|Aeronaves Tsm|Aerologic|Aitheras',
    'i') as is_freight, count(*) as parts
from part group by 1, 2, 3""")
def keyword_class(t: Tables) -> DataFrame:
    """B14. Case-insensitive keyword lists, anchors included."""
    freight = F.when(F.col("p_size") > 30, F.concat(F.lit("Fedex "), "p_name")).otherwise(F.col("p_name"))
    return t.part.groupBy(has_keyword("p_name", "ring|widget|^old").alias("is_cargo"),
                          has_keyword("p_type", "PROM|economy").alias("is_promo"),
                          has_keyword(freight, config.CARGO_WORDS).alias("is_freight")
                          ).agg(F.count(F.lit(1)).alias("parts"))


@query("event_key", """
select event_id, event_type || user_id || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as event_key,
  coalesce(case when user_id > 75 then 'u' || user_id end, case when value > 50 then 'v' end, event_type) as identity
from events""")
def event_key_query(t: Tables) -> DataFrame:
    """B10, B15. A text key with milliseconds, and the first identity that is known."""
    return t.events.select(
        "event_id", event_key(F.concat("event_type", F.col("user_id").cast("string")), "ts").alias("event_key"),
        first_known(F.when(F.col("user_id") > 75, F.concat(F.lit("u"), F.col("user_id").cast("string"))),
                    F.when(F.col("value") > 50, "v"), "event_type").alias("identity"))


@query("batch_dates", """
select event_id, (ts + interval 15 hour)::date as batch_date,
  strftime(ts + interval 15 hour, '%Y-%m-%d') || ' ' || event_type as batch,
  (epoch_us((ts + interval 15 hour)::date::timestamp + interval 9 hour) - epoch_us(ts)) / 3.6e9 as hours_before
from events""")
def batch_dates(t: Tables) -> DataFrame:
    """B27, B28, B35. Which pull collected an event, and how long before it."""
    day = batch_date("ts")
    pull = day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(9))
    return t.events.select("event_id", day.alias("batch_date"), batch_id(day, "event_type").alias("batch"),
                           hours_between("ts", pull).alias("hours_before"))


@query("time_of_day", """
select case when hour(ts) < 6 then 'night (0-5)' when hour(ts) < 12 then 'morning (6-11)'
    when hour(ts) < 18 then 'afternoon (12-17)' else 'evening (18-23)' end as slot, hour(ts) // 6 as slot_order,
  count(*) as events, round(avg(case when value > 100 then 1.0 else 0.0 end), 6) as high_rate
from events group by 1, 2""")
def time_of_day_query(t: Tables) -> DataFrame:
    """B25. Four half-open bins and their order."""
    slot = time_of_day(F.hour("ts"))
    return t.events.groupBy(slot.alias("slot"), time_of_day_order(slot).cast("bigint").alias("slot_order")).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.avg(F.when(F.col("value") > 100, 1.0).otherwise(0.0)), 6).alias("high_rate"))


@query("right_closed_bins", """
select case when h > 2 and h <= 4 then '(2, 4]' when h > 4 and h <= 6 then '(4, 6]' when h > 6 and h <= 8 then '(6, 8]'
    when h > 8 and h <= 12 then '(8, 12]' when h > 12 and h <= 24 then '(12, 24]' end as bin,
  count(*) as lines, max(l_extendedprice) as largest
from (select l_quantity / 2 as h, l_extendedprice from lineitem) group by 1""")
def right_closed_bins(t: Tables) -> DataFrame:
    """B26. Intervals open on the left, closed on the right; the rest is NULL."""
    return t.lineitem.groupBy(bin_right_closed(F.col("l_quantity") / 2, [2, 4, 6, 8, 12, 24]).alias("bin")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_extendedprice").alias("largest"))


@query("late_thresholds", """
select k, count_if(coalesce(d >= case when l_returnflag = 'R' then k - 2 else k end, false)) as late
from (select date_diff('day', o_orderdate, l_shipdate) as d, l_returnflag from lineitem
  join orders on l_orderkey = o_orderkey), (values (5), (10), (15), (20)) v(k) group by 1""")
def late_thresholds(t: Tables) -> DataFrame:
    """B33. Lateness at several thresholds at once, shifted for one group."""
    delay = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        datediff_boundary("day", "o_orderdate", "l_shipdate").alias("d"), "l_returnflag")
    cuts = [5, 10, 15, 20]
    one = delay.agg(*[F.count_if(late_at("d", k, F.col("l_returnflag") == "R", k - 2)).alias(str(k)) for k in cuts])
    return one.unpivot([], [F.col(f"`{k}`") for k in cuts], "k", "late").withColumn("k", F.col("k").cast("int"))


@query("map_values", """
select level, known, count(*) as events from (
  select case event_type when 'click' then 'light' when 'view' then 'moderate' when 'error' then 'heavy' else 'none' end
    as level, event_type in ('click', 'view', 'error') as known from events) group by 1, 2""")
def map_values_query(t: Tables) -> DataFrame:
    """B29. A fixed mapping with a default."""
    levels = {"click": "light", "view": "moderate", "error": "heavy"}
    return t.events.groupBy(map_values("event_type", levels, "none").alias("level"),
                            F.col("event_type").isin(*levels).alias("known")).agg(F.count(F.lit(1)).alias("events"))


@query("unmapped_values", """
select event_type, count(*) as rows from events where event_type not in ('click', 'view', 'error') group by 1""")
def unmapped_values_query(t: Tables) -> DataFrame:
    """B29. What the mapping does not know."""
    return unmapped_values(t.events, "event_type", {"click": "", "view": "", "error": ""})


@query("rare_to_other", """
with frequent as (select user_id from events group by 1 having count(*) >= 67)
select coalesce(f.user_id::varchar, 'Other') as user_group, count(*) as events, round(sum(value), 4) as total
from events e left join frequent f using (user_id) group by 1""")
def rare_to_other_query(t: Tables) -> DataFrame:
    """B31. Keys under a minimum count become one group."""
    users = t.events.withColumn("user", F.col("user_id").cast("string"))
    return rare_to_other(users, "user", min_count=67, name="user_group").groupBy("user_group").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total"))


@query("rare_to_other_listed", """
select case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_mktsegment else 'Other' end as segment,
  count(*) as customers, round(avg(c_acctbal), 9) as balance from customer group by 1""")
def rare_to_other_listed(t: Tables) -> DataFrame:
    """B31. Keep a fixed list, the rest is Other."""
    return rare_to_other(t.customer, "c_mktsegment", keep=["BUILDING", "MACHINERY"], name="segment").groupBy(
        "segment").agg(F.count(F.lit(1)).alias("customers"), F.round(F.avg("c_acctbal"), 9).alias("balance"))


@query("scope_semi", """
select n_name, count(*) as customers, round(sum(c_acctbal), 4) as balance
from customer join nation on c_nationkey = n_nationkey
where n_regionkey in (select r_regionkey from region where r_name in ('ASIA', 'EUROPE')) group by 1""")
def scope_semi(t: Tables) -> DataFrame:
    """C1, D1. Scope by membership in a dimension."""
    regions = t.region.where(F.col("r_name").isin("ASIA", "EUROPE"))
    nations = in_scope(t.nation, regions, "n_regionkey", "r_regionkey")
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 4).alias("balance"))


@query("range_checks", """
select count_if(v not between 30 and 70) as outside, count_if(v between 30 and 70) as inside,
  count_if(v is null) as unknown, count_if(not coalesce(v between 30 and 70, false)) as not_surely_inside
from (select case when event_type <> 'view' then value end as v from events)""")
def range_checks(t: Tables) -> DataFrame:
    """C3, M8, M9. NULL is neither inside nor outside a range."""
    v = F.col("v")
    rows = t.events.select(F.when(F.col("event_type") != "view", F.col("value")).alias("v"))
    return rows.agg(F.count_if(outside(v, 30, 70)).alias("outside"), F.count_if(v.between(30, 70)).alias("inside"),
                    F.count_if(v.isNull()).alias("unknown"),
                    F.count_if(~flag(v.between(30, 70))).alias("not_surely_inside"))


@query("dim_left_missing", """
select c_custkey, max(o_orderdate) as last_order, count(o_orderkey) as orders
from customer left join orders on c_custkey = o_custkey and o_orderstatus = 'F' group by 1""")
def dim_left_missing(t: Tables) -> DataFrame:
    """D5. Start from the members, so that silent ones appear."""
    finished = t.orders.where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return left_from_dim(t.customer, finished, "c_custkey", last_order=F.max("o_orderdate"),
                         orders=F.count("o_orderkey")).fillna(0, ["orders"])


@query("missing_members", """
select c_custkey from customer where c_custkey not in (
  select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F' and o_custkey is not null)""")
def missing_members_query(t: Tables) -> DataFrame:
    """D6, G5. Members without a counterpart."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'")
    return missing_members(t.customer.select("c_custkey"), urgent, "c_custkey", "o_custkey")


@query("union_keys", """
select key_type, designator, count(distinct (a, b)) filter (where a is not null and b is not null) as routes
from (
  select 'part' as key_type, l_partkey as designator, l_returnflag as a,
    case when l_quantity < 40 then l_linestatus end as b from lineitem
  union all
  select 'supplier', l_suppkey, l_returnflag, case when l_quantity < 40 then l_linestatus end from lineitem)
group by 1, 2""")
def union_keys_query(t: Tables) -> DataFrame:
    """G3, E15, M11. Two key variants; distinct pairs ignore rows with a NULL in either."""
    route = [F.col("l_returnflag").alias("a"), F.when(F.col("l_quantity") < 40, F.col("l_linestatus")).alias("b")]
    keys = union_keys([
        t.lineitem.select(F.lit("part").alias("key_type"), F.col("l_partkey").alias("designator"), *route),
        t.lineitem.select(F.lit("supplier").alias("key_type"), F.col("l_suppkey").alias("designator"), *route)])
    return distinct_count(keys, ["key_type", "designator"], ["a", "b"], "routes")


@query("case_split", """
select upper(k) as normalized, count(*) as rows, count(distinct k) as spellings
from (select case when p_size > 25 then upper(p_name) else p_name end as k from part)
group by 1 having count(distinct k) > 1""")
def case_split(t: Tables) -> DataFrame:
    """H11, C8. Keys that differ only by letter case."""
    spelled = t.part.select(F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("k"))
    per_spelling = spelled.groupBy(F.upper("k").alias("normalized"), "k").agg(F.count(F.lit(1)).alias("_n"))
    return per_spelling.groupBy("normalized").agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("spellings")).where("spellings > 1")
