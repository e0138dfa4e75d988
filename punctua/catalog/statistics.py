"""Intervals, tests and models over the given tables, and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.catalog.core import _LATEST_SQL, LINE_ORDER
from punctua.catalog.derived import written
from punctua.catalog.registry import SQL, Tables, query
from punctua.functions import datediff_boundary, flag
from punctua.operators import assert_sample, rate_by
from punctua.session import shared_dir
from punctua.stats import (Model, Study, Variant, average_marginal_effect, batch_draws, cluster_bootstrap, cross_controls, draw_interval, effect_table, fit_logit,
                           leave_out_fits, fit_variants, holm, lateness_grid, leave_one_out, number, odds_ratios, percentile_interval, power, robust_claims,
                           shift_grid, study_summary, two_proportion_z, variant_table, vif, wilson_interval)
from punctua.stats.bootstrap import LAST_SHIFT, MASK, MIX, mixed
from punctua.streaming import hourly_arrivals, read_hours, read_latest, start_hours, start_upsert, write_batch

_RATES_SQL = """
with counts as (select l_shipmode as g, n, k from (
  select l_returnflag || l_linestatus as l_shipmode, count(*) as n, count_if(l_quantity > 40) as k from lineitem group by 1))"""


def _rates(t: Tables) -> DataFrame:
    return rate_by(t.lineitem.withColumn("g", F.concat("l_returnflag", "l_linestatus")), ["g"], F.col("l_quantity") > 40)


@query("wilson", f"""{_RATES_SQL}, z as (select *, 1.959963984540054 as z, k / n::double as p from counts)
select g, n as rows, k as late, round(p, 9) as late_rate,
  round((p + z*z/(2*n) - z * sqrt(p*(1-p)/n + z*z/(4.0*n*n))) / (1 + z*z/n), 9) as ci_low,
  round((p + z*z/(2*n) + z * sqrt(p*(1-p)/n + z*z/(4.0*n*n))) / (1 + z*z/n), 9) as ci_high from z""")
def wilson(t: Tables) -> DataFrame:
    """L1, E10."""
    return wilson_interval(_rates(t)).withColumns({c: F.round(c, 9) for c in ("late_rate", "ci_low", "ci_high")})


@query("two_proportion_z", f"""{_RATES_SQL}, base as (select n as n0, k as k0 from counts where g = 'AF')
select g, n as rows, round(k / n::double, 9) as rate, round(k0 / n0::double, 9) as base_rate,
  round((k0/n0::double - k/n::double) / sqrt(((k0+k)/(n0+n)::double) * (1 - (k0+k)/(n0+n)::double) * (1.0/n0 + 1.0/n)), 6) as z
from counts, base where g <> 'AF'""")
def two_proportions(t: Tables) -> DataFrame:
    """L2. One group against each other one."""
    out = two_proportion_z(_rates(t), "g", "AF").drop("p_value")
    return out.withColumns({"rate": F.round("rate", 9), "base_rate": F.round("base_rate", 9), "z": F.round("z", 6)})


@query("holm", """
with p as (select l_returnflag as family, l_linestatus || l_linenumber as test,
    round(count_if(l_quantity = 50) / count(*)::double, 9) as p_value from lineitem group by 1, 2),
ranked as (select *, row_number() over (partition by family order by p_value, test) as r,
  count(*) over (partition by family) as m from p)
select family, test, p_value, round(least(1.0, max((m - r + 1) * p_value) over (
  partition by family order by r rows between unbounded preceding and current row)), 9) as holm_p from ranked""")
def holm_query(t: Tables) -> DataFrame:
    """L9. Families of small p-values, adjusted."""
    p = t.lineitem.groupBy(F.col("l_returnflag").alias("family"),
                           F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("test")).agg(
        F.round(F.count_if(F.col("l_quantity") == 50) / F.count(F.lit(1)), 9).alias("p_value"))
    return holm(p, by=["family"]).withColumn("holm_p", F.round("holm_p", 9))


@query("vif", """
select 'l_quantity' as term, round(1 / (1 - corr(l_quantity, l_extendedprice) ** 2), 6) as vif from lineitem
union all select 'l_extendedprice', round(1 / (1 - corr(l_quantity, l_extendedprice) ** 2), 6) from lineitem""")
def vif_query(t: Tables) -> DataFrame:
    """L3, L4. Two inputs, so the inflation has a closed form."""
    found = vif(t.lineitem, {**number("l_quantity"), **number("l_extendedprice")})
    return t.spark.createDataFrame([(k, round(v, 6)) for k, v in found.items()], "term STRING, vif DOUBLE")


def _labelled(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")


@query("logit_binary", """
with d as (select toxic as y, quality as x, source as c from labels join documents using (doc_id)),
g as (select count(*)::double as n, count(distinct c)::double as clusters, avg(y) filter (where x = 1) as p1,
  avg(y) filter (where x = 0) as p0, count_if(x = 1)::double as n1, count_if(x = 0)::double as n0 from d),
s as (select c, sum(case when x = 1 then (y - p1) / (n1 * p1 * (1 - p1)) else -(y - p0) / (n0 * p0 * (1 - p0)) end) as u
  from d, g group by 1),
v as (select sum(u * u) as v from s),
e as (select ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) as b,
  sqrt(v * clusters / (clusters - 1) * (n - 1) / (n - 2)) as se, n, clusters from g, v)
select 'quality' as term, n as rows, clusters::bigint as clusters, round(exp(b), 6) as odds_ratio,
  round(exp(b - 1.959963984540054 * se), 6) as ci_low, round(exp(b + 1.959963984540054 * se), 6) as ci_high from e""")
def logit_binary(t: Tables) -> DataFrame:
    """L5-L7. One 0/1 input, where the estimate and its clustered error have a closed form."""
    fit = fit_logit(_labelled(t), number("quality"), "toxic", "source")
    r = odds_ratios(fit)[0]
    return t.spark.createDataFrame(
        [(r["term"], fit.n, fit.clusters, *[round(r[c], 6) for c in ("odds_ratio", "ci_low", "ci_high")])],
        "term STRING, rows DOUBLE, clusters BIGINT, odds_ratio DOUBLE, ci_low DOUBLE, ci_high DOUBLE")


@query("logit_clustered")
def logit_clustered(t: Tables) -> DataFrame:
    """L3, L5-L8. Toxicity given quality, length and language, clustered by source, with marginal effects."""
    data = _labelled(t).withColumn("kchars", F.col("n_chars") / 1000)
    terms = {**number("quality"), **number("kchars")}
    fit = fit_logit(data, terms, "toxic", "source")
    effect = average_marginal_effect(data, terms, fit, "quality")
    rows = [(r["term"], r["odds_ratio"], r["ci_low"], r["ci_high"], r["p_value"],
             effect["effect"] if r["term"] == "quality" else None) for r in odds_ratios(fit)]
    return t.spark.createDataFrame(
        rows, "term STRING, odds_ratio DOUBLE, ci_low DOUBLE, ci_high DOUBLE, p_value DOUBLE, effect DOUBLE")


def _late_lines(t: Tables) -> DataFrame:
    days = datediff_boundary("day", "o_orderdate", "l_shipdate")
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("place"), (F.col("l_returnflag") == "R").cast("int").alias("is_base"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"), (F.col("l_tax") > 0.06).cast("int").alias("taxed"),
        F.floor(F.col("l_quantity") / 10).alias("size"), days.alias("days"), flag(days >= 15).cast("int").alias("is_late"),
        F.concat_ws(" ", F.date_format("o_orderdate", "yyyy-MM"), "l_returnflag").alias("batch"),
        F.date_format("o_orderdate", "yyyy").alias("year"), "o_orderpriority", F.floor(F.col("l_discount") * 100).alias("discount"))


def _lateness(t: Tables) -> tuple[DataFrame, Study]:
    """Line items as events: shipped 15 or more days after the order is late; a batch is a month and flag.

    The rows are written once: a study reads them in several passes, each of which would join line items and orders again.
    """
    rows = written(t, "lateness", lambda: _late_lines(t))
    study = Study("is_base", "place", ("A", "N", "R"), "R", F.col("is_late"),
                  {**number("is_open"), **number("taxed"), **number("size")}, "batch")
    return rows, study


@query("study_verdicts")
def study_verdicts(t: Tables) -> DataFrame:
    """L5-L12. Estimates, clustered and bootstrap intervals (999 repetitions), Holm, verdicts."""
    rows, study = _lateness(t)
    return study_summary(rows, study, "place", seed=2026)[0]


@query("study_variants")
def study_variants(t: Tables) -> DataFrame:
    """L13, L18, L19, L20, B33. Both models under one change at a time, and a grid of lateness cut-offs."""
    rows, study = _lateness(t)
    full = tuple(study.controls)
    variants = [Variant("main", full), Variant("no size", full[:2]), Variant("untaxed", full[::2], F.col("taxed") == 0),
                Variant("by year", full, cluster="year"),
                *lateness_grid(study, "days", {f"late at {k}": (k, k) for k in (5, 10, 20)}),
                *lateness_grid(study, "days", {f"base shifted {k:+d}": (15, 15 - k) for k in (-4, -2, 2, 4)})]
    return variant_table(rows, study, fit_variants(rows, study, variants))


_GRID_SQL = """
with late as (select l_returnflag as place, strftime(o_orderdate, '%Y-%m') || ' ' || l_returnflag as batch, date_diff('day', o_orderdate, l_shipdate) as days,
    count(*) as n from lineitem join orders on l_orderkey = o_orderkey group by all),
c as (select cut, shift, place, batch, sum(n) as n, coalesce(sum(n) filter (days >= cut - case when place = 'R' then shift else 0 end), 0) as h
  from late, (values (5), (10), (15), (20)) as t(cut), range(-4, 5) as r(shift) group by all),
w as (select cut, shift, sum(n)::double as rows, sum(h)::double as late, count(distinct batch)::double as g from c group by all),
sides(comparison, k, place, x) as (values ('R vs rest', 2, 'R', 1), ('R vs rest', 2, 'A', -1), ('R vs rest', 2, 'N', -1),
  ('A', 3, 'A', 1), ('A', 3, 'R', -1), ('N', 3, 'N', 1), ('N', 3, 'R', -1)),
p as (select cut, shift, comparison, k, x, sum(n)::double as m, sum(h) / sum(n)::double as p from c join sides using (place) group by all),
u as (select cut, shift, comparison, batch, sum(x * (h - n * p) / (m * p * (1 - p))) as ub, sum(x * (h - n * p) / m) as ue
  from c join sides using (place) join p using (cut, shift, comparison, k, x) group by all),
v as (select cut, shift, comparison, sum(ub * ub) as vb, sum(ue * ue) as ve from u group by all),
e as (select cut, shift, comparison, k, sum(x * ln(p / (1 - p))) as b, sum(x * p) as effect from p group by all),
s as (select *, (g / (g - 1)) * ((rows - 1) / (rows - k)) as size from e join v using (cut, shift, comparison) join w using (cut, shift))
select 'late at ' || cut || ', shift ' || case when shift < 0 then '' else '+' end || shift as variant, comparison, rows, late, round(exp(b), 5) as odds_ratio,
  round(exp(b - 1.959963984540054 * sqrt(vb * size)), 5) as ci_low, round(exp(b + 1.959963984540054 * sqrt(vb * size)), 5) as ci_high,
  round(effect, 7) as effect, round(effect - 1.959963984540054 * sqrt(ve * size), 7) as effect_low, round(effect + 1.959963984540054 * sqrt(ve * size), 7) as effect_high
from s"""


@query("study_shift_grid", _GRID_SQL)
def study_shift_grid(t: Tables) -> DataFrame:
    """L8, L18, B33. Cut-offs 5, 10, 15, 20 by group shifts -4 to 4: 72 models in shared passes, all effects in one more. Without controls
    odds ratios, effects and their clustered errors have a closed form."""
    rows, study = _lateness(t)
    table = effect_table(rows, study, shift_grid(study, "days", controls=()))
    exact = {c: F.round(c, 5) for c in ("odds_ratio", "ci_low", "ci_high")} | {c: F.round(c, 7) for c in ("effect", "effect_low", "effect_high")}
    return table.withColumns(exact).drop("p_value", "side")


@query("study_operator_grid")
def study_operator_grid(t: Tables) -> DataFrame:
    """L8, L16, L19. Four samples by three versions of the model (an input as fitted, swapped for another, left out), with effects."""
    rows, study = _lateness(t)
    full = tuple(study.controls)
    priority = F.col("o_orderpriority")
    samples = [Variant("as fitted", full), Variant("no urgent orders", full, priority != "1-URGENT"),
               Variant("untaxed", tuple(c for c in full if c != "taxed"), F.col("taxed") == 0), Variant("high priority", full, priority.isin("1-URGENT", "2-HIGH"))]
    versions = {"size": ({}, ()), "discount": ({"size": "discount"}, ()), "neither": ({}, ("size",))}
    return effect_table(rows, study, cross_controls(samples, versions), number("discount"))


@query("study_robustness")
def study_robustness(t: Tables) -> DataFrame:
    """L14, L15. Leave each batch out, and which claims survive every check."""
    rows, study = _lateness(t)
    full = tuple(study.controls)
    checks = [Variant("no size", full[:2]), Variant("untaxed", full[::2], F.col("taxed") == 0)]
    variants = variant_table(rows, study, fit_variants(rows, study, checks))
    left_out = leave_one_out(rows, study, "batch")
    summary = study_summary(rows, study, "place", reps=100)[0]
    robust = robust_claims(summary, variants, left_out, "R", ["no size"], ["untaxed"])
    return left_out.join(robust, "comparison", "left")


_LATE_SQL = """
with late as (select l_returnflag as place, strftime(o_orderdate, '%Y-%m') || ' ' || l_returnflag as batch, l_returnflag = 'R' as own, l_linestatus = 'O' as open,
    date_diff('day', o_orderdate, l_shipdate) >= 15 as hit from lineitem join orders on l_orderkey = o_orderkey)"""


@query("leave_one_batch_out", f"""{_LATE_SQL},
c as (select batch, count_if(own and hit) as a, count_if(own and not hit) as b, count_if(not own and hit) as c, count_if(not own and not hit) as d,
  count(*) as n, count_if(hit) as h from late group by 1),
t as (select sum(a) as a, sum(b) as b, sum(c) as c, sum(d) as d, sum(n) as n, sum(h) as h from c)
select batch, (t.n - c.n)::double as rows, (t.h - c.h)::double as late,
  round(((t.a - c.a)::double * (t.d - c.d)) / ((t.b - c.b)::double * (t.c - c.c)), 6) as odds_ratio from c, t""")
def leave_one_batch_out(t: Tables) -> DataFrame:
    """L14. The primary model refitted without each of some 250 batches; with one 0/1 input the refit has a closed form."""
    rows, study = _lateness(t)
    fits = leave_out_fits(rows, number("is_base"), [Model("primary", ("is_base",), study.outcome)], "batch")
    return fits.select("batch", "rows", "late", F.round("odds_ratio", 6).alias("odds_ratio"))


def _drawn_sql(reps: int, seed: int) -> str:
    """Steps ``numbered`` (batches by stratum) and ``drawn`` (how often each repetition draws a batch)."""
    step, parts = "x0", [f"x0 as (select *, {mixed(seed)}::bigint as x from numbered, range({reps}) as r(rep))"]
    for i, source in enumerate(("rep", "s", "i")):
        parts.append(f"y{i} as (select * replace (xor(x, {source}) as x) from {step})")
        step = f"y{i}"
        for j, (shift, factor) in enumerate(MIX):
            parts.append(f"z{i}{j} as (select * replace ((xor(x, x >> {shift}) * {factor}) & {MASK} as x) from {step})")
            step = f"z{i}{j}"
        parts.append(f"w{i} as (select * replace (xor(x, x >> {LAST_SHIFT}) as x) from {step})")
        step = f"w{i}"
    return f"""numbered as (select place, batch, dense_rank() over (order by place) - 1 as s, row_number() over (partition by place order by batch) - 1 as i,
  count(*) over (partition by place) as size from (select distinct place, batch from late)),
{", ".join(parts)},
drawn as (select p.place, p.batch, d.rep, count(*) as n from {step} d join numbered p on p.s = d.s and p.i = d.x % d.size group by all)"""


@query("bootstrap_draws", f"{_LATE_SQL}, {_drawn_sql(999, 2026)} select place, batch, rep::int as rep, n from drawn")
def bootstrap_draws(t: Tables) -> DataFrame:
    """L10. Which batches each of 999 repetitions draws."""
    return batch_draws(_lateness(t)[0], "place", "batch", 999, 2026)


@query("bootstrap_interval", f"""{_LATE_SQL}, {_drawn_sql(999, 2026)},
c as (select batch, count_if(open and hit)::double as a, count_if(open and not hit)::double as b, count_if(not open and hit)::double as c,
  count_if(not open and not hit)::double as d from late group by 1),
o as (select rep, (sum(n * a) * sum(n * d)) / (sum(n * b) * sum(n * c)) as odds from drawn join c using (batch) group by 1)
select 'is_open' as term, count(*) as kept, round(quantile_cont(odds, 0.025), 6) as boot_low, round(quantile_cont(odds, 0.975), 6) as boot_high from o""")
def bootstrap_interval(t: Tables) -> DataFrame:
    """L10, L11. 999 refits of a model with one 0/1 input, whose odds ratio has a closed form in every repetition."""
    rows, study = _lateness(t)
    boot = cluster_bootstrap(rows, number("is_open"), study.outcome, {"main": ["is_open"]}, "place", "batch", 999, 2026)
    low, high = draw_interval(boot, "main", "is_open")
    return t.spark.createDataFrame([("is_open", len(boot["draws"]), round(low, 6), round(high, 6))], "term STRING, kept BIGINT, boot_low DOUBLE, boot_high DOUBLE")


@query("draw_intervals", """
select event_type, round(quantile_cont(value, 0.025), 6) as boot_low, round(quantile_cont(value, 0.975), 6) as boot_high
from events group by 1""")
def draw_intervals(t: Tables) -> DataFrame:
    """L11. The middle 95% per term."""
    return percentile_interval(t.events, "value", ["event_type"]).withColumns(
        {c: F.round(c, 6) for c in ("boot_low", "boot_high")})


def _line_order() -> list:
    return [LINE_ORDER[0](c) for c in LINE_ORDER[1:]]


@query("stream_upsert", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
from ({_LATEST_SQL})""")
def stream_upsert(t: Tables) -> DataFrame:
    """A2, K1, K2, K5. All lines dropped in three portions, each loaded incrementally; equals the batch result."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    lines, root, keys = t.lineitem.select(*cols), shared_dir(t.spark, "drops"), ["l_orderkey", "l_linenumber"]
    portions = [F.col("l_quantity") <= 20, (F.col("l_quantity") > 20) & (F.col("l_quantity") <= 35), F.col("l_quantity") > 35]
    for i, portion in enumerate(portions):
        write_batch(lines.where(portion), i, f"{root}/landing")
        stream = t.spark.readStream.schema(lines.schema).parquet(f"{root}/landing/*")
        start_upsert(stream, f"{root}/table", f"{root}/checkpoint", keys, _line_order).awaitTermination()
    return read_latest(t.spark, f"{root}/table", keys, _line_order).select(*cols)


@query("stream_hourly", """
select date_trunc('hour', ts) as hour, event_type, count(*) as rows, max(ts) as newest from events group by 1, 2""")
def stream_hourly(t: Tables) -> DataFrame:
    """K4. Hourly counts on event time. Every event is on time within the watermark, so all hours close."""
    root = shared_dir(t.spark, "hourly")
    real = t.events.select("ts", "event_type", F.lit(True).alias("real"))
    write_batch(real, 0, f"{root}/landing")
    # A row far ahead moves the watermark past the last real hour; it is left out of the result.
    ahead = t.events.agg(F.max("ts").alias("ts")).select(
        (F.col("ts") + F.make_dt_interval(days=F.lit(2))).alias("ts"), F.lit(None).cast("string").alias("event_type"), F.lit(False).alias("real"))
    write_batch(ahead, 1, f"{root}/landing")
    stream = t.spark.readStream.schema(real.schema).parquet(f"{root}/landing/*")
    hourly = hourly_arrivals(stream, "ts", ["event_type", "real"], delay="2 hours")
    (hourly.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .option("path", f"{root}/out").outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return t.spark.read.parquet(f"{root}/out").where("real").select(
        F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", "rows", F.col("newest").cast("timestamp_ntz").alias("newest"))


_PORTION = "event_id % 3"


@query("stream_hours_late", f"""
with p as (select *, {_PORTION} as portion from events),
b as (select portion, max(ts) as newest from p group by 1)
select date_trunc('hour', ts) as hour, event_type, count(*) as rows, max(ts) as newest,
  count_if(coalesce(ts < (select max(newest) from b where b.portion < p.portion) - interval 7 day, false)) as late from p group by 1, 2""")
def stream_hours_late(t: Tables) -> DataFrame:
    """K4. Hourly counts when two thirds of the events land after later ones: none is left out, and the late ones are counted."""
    root = shared_dir(t.spark, "hours")
    events = t.events.select("ts", "event_type", F.expr(_PORTION).alias("portion"))
    for i in range(3):
        write_batch(events.where(F.col("portion") == i).drop("portion"), i, f"{root}/landing")
        stream = t.spark.readStream.schema(events.drop("portion").schema).parquet(f"{root}/landing/*")
        start_hours(stream, f"{root}/table", f"{root}/checkpoint", "ts", ["event_type"], F.make_dt_interval(days=F.lit(7))).awaitTermination()
    return read_hours(t.spark, f"{root}/table", ["event_type"]).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("hour", "newest")})


_ESTIMATE_SQL = SQL["logit_binary"].replace("\nselect 'quality' as term", ",\no as (select 'quality' as term") + ")"


@query("power", _ESTIMATE_SQL + """,
f as (select n_ratio, 1.96 - ln(odds_ratio) / ((ln(ci_high) - ln(ci_low)) / (2 * 1.96) * sqrt(n_ratio)) as x from o, (values (0.25), (0.5), (1.0), (2.0), (4.0)) as r(n_ratio)),
series as (select n_ratio, x, sum((case when n % 2 = 0 then 1 else -1 end) * exp((2 * n + 1) * ln(abs(x)) - lgamma(n + 1) - n * ln(2)) / (2 * n + 1)) as t from f, range(90) as r(n) group by all)
select n_ratio::double as n_ratio, round(0.5 - sign(x) * t / sqrt(2 * pi()), 5) as power from series""")
def power_query(t: Tables) -> DataFrame:
    """L17. The chance that a repeat of the comparison with more or fewer clusters clears 1, if the estimate is true."""
    r = odds_ratios(fit_logit(_labelled(t), number("quality"), "toxic", "source"))[0]
    odds, low, high = (round(r[c], 6) for c in ("odds_ratio", "ci_low", "ci_high"))
    return t.spark.createDataFrame([(n, round(power(odds, low, high, n), 5)) for n in (0.25, 0.5, 1.0, 2.0, 4.0)], "n_ratio DOUBLE, power DOUBLE")


@query("sample_asserted", f"""{_LATE_SQL},
s as (select count(*) as rows, count_if(hit) as late, count(distinct batch) as batches from late)
select 'as expected' as case_name, rows, late, batches, false as stopped from s union all select 'one row more', rows + 1, late, batches, true from s""")
def sample_asserted(t: Tables) -> DataFrame:
    """C9. The sample goes on if rows, late rows and batches are those counted beforehand, and is stopped if one row is missing."""
    sample = _lateness(t)[0]
    measures = {"rows": F.count(F.lit(1)), "late": F.sum("is_late"), "batches": F.count_distinct("batch")}
    expected = sample.agg(*[c.alias(n) for n, c in measures.items()]).first().asDict()
    cases = []
    for name, wanted in (("as expected", expected), ("one row more", expected | {"rows": expected["rows"] + 1})):
        try:
            assert_sample(sample, wanted, measures)
            cases.append((name, *wanted.values(), False))
        except AssertionError:
            cases.append((name, *wanted.values(), True))
    return t.spark.createDataFrame(cases, "case_name STRING, rows BIGINT, late BIGINT, batches BIGINT, stopped BOOLEAN")
