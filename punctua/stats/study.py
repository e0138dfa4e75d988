"""The comparison study: a pre-registered pair of models, its checks, and the rules that read them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import config
from punctua.stats.bootstrap import cluster_bootstrap, draw_interval
from punctua.stats.intervals import holm, interval_side
from punctua.stats.left_out import leave_out_fits
from punctua.stats.logit import Fit, Model, factor, fit_logits, marginal_effects, number, odds_ratios

__all__ = [
    "Study", "Variant", "cross_controls", "delay_checks", "delay_operator_grid", "delay_study", "effect_table", "fit_variants", "leave_one_out",
    "lateness_grid", "model_versions", "pairwise_verdict", "primary_holds", "robust_claims", "shift_grid", "study_summary", "variant_table",
]


@dataclass(frozen=True)
class Study:
    """Group against the rest (primary) and every other level against the group (secondary)."""

    group: str                      # 0/1 input of the primary model
    level: str                      # factor of the secondary model
    levels: tuple[str, ...]         # all levels, the base included
    base: str                       # the level the group stands for
    outcome: Column
    controls: Mapping[str, Column]
    cluster: str

    @property
    def pairs(self) -> dict[str, str]:
        """Secondary term -> level."""
        return {f"{self.level}[{v}]": v for v in self.levels if v != self.base}

    def terms(self, extra: Mapping[str, Column] = {}) -> dict[str, Column]:
        return {**number(self.group), **factor(self.level, self.levels, self.base), **self.controls, **extra}


@dataclass(frozen=True)
class Variant:
    """One change to the main model."""

    name: str
    controls: tuple[str, ...]
    rows: Column | None = None
    outcome: Column | None = None
    cluster: str | None = None


def delay_study(wind: str = "weather_wind_speed") -> Study:
    """The fixed specification: base airport against the rest, given night, carrier, cargo and wind."""
    return Study("is_sfo", "arrival_airport", (*config.MODEL_AIRPORTS, config.BASE_AIRPORT), config.BASE_AIRPORT,
                 F.col("is_late"),
                 {**number("is_night"),
                  **factor("carrier_group", (*config.MODEL_CARRIERS, "Other"), config.BASE_CARRIER),
                  **number("cargo"), **number(wind)}, "batch")


def _levels(df: DataFrame, col: str) -> list[str]:
    return sorted(str(r[0]) for r in df.select(col).distinct().collect())


def delay_checks(rows: DataFrame, study: Study, wind: str = "weather_wind_speed",
                 min_carrier: int = 40) -> tuple[list[Variant], dict[str, Column]]:
    """L13. The checks fixed in advance, over ``study_rows``, and the inputs they add.

    Pulls and frequent carriers become model terms, so their lists are as short as a model is wide.
    """
    main = F.col("in_sample")
    full = tuple(study.controls)
    calm, no_cargo = tuple(c for c in full if c != wind), tuple(c for c in full if c != "cargo")
    sample = rows.where(main)
    pulls = _levels(sample.withColumn("pull", F.col("pull_date").cast("string")), "pull")
    pull_terms = {f"pull[{d}]": (F.col("pull_date") == F.lit(d).cast("date")).cast("double") for d in pulls[1:]}
    frequent = _levels(sample.groupBy("carrier").count().where((F.col("count") >= min_carrier)
                                                              & (F.col("carrier") != config.BASE_CARRIER)), "carrier")
    listed = F.col("carrier").isin(*frequent, config.BASE_CARRIER)
    wide = {f"carrier[{c}]": (F.col("carrier") == c).cast("double") for c in frequent}
    wide["carrier[Other]"] = (~F.coalesce(listed, F.lit(False))).cast("double")
    wide = {k: F.coalesce(v, F.lit(0.0)) for k, v in wide.items()}
    others = tuple(c for c in full if not c.startswith("carrier_group["))
    extra = {**number("scheduled_duration_hours"), **pull_terms, **wide}
    scheduled = F.col("scheduled_operator")
    return [
        Variant("main", full, main), Variant("R1 no wind", calm, main),
        Variant("R2 + flight length", (*full, "scheduled_duration_hours"),
                main & F.col("scheduled_duration_hours").isNotNull()),
        Variant("R3 passenger only", no_cargo, main & (F.col("cargo") == 0)),
        Variant("R4 + pull indicators", (*full, *pull_terms), main),
        Variant("R6 + manual pulls (no wind)", calm,
                scheduled & ((F.col("in_window") & F.col("early_enough")) | F.col("manual_pull")), cluster="date_batch"),
        Variant("R7 no 2-hour filter", full, F.col("in_window") & scheduled),
        Variant("R8 lower carrier cut-off", (*others, *wide), main),
    ], extra


def delay_operator_grid(study: Study) -> tuple[list[Variant], dict[str, Column]]:
    """L19, B14. Samples that treat operators with an untrustworthy schedule differently."""
    main, full = F.col("in_sample"), tuple(study.controls)
    corrected = tuple("corrected_cargo" if c == "cargo" else c for c in full)
    trusted = ~F.col("schedule_is_landing") & ~F.col("missed_cargo") & ~F.col("missed_non_scheduled")
    return [
        Variant("as fitted", full, main),
        Variant("schedule-is-landing operators dropped", full, main & ~F.col("schedule_is_landing")),
        Variant("corrected keyword lists", corrected, main & ~F.col("missed_non_scheduled")),
        Variant("scheduled passenger airlines only", tuple(c for c in full if c != "cargo"),
                main & (F.col("cargo") == 0) & trusted),
    ], number("corrected_cargo")


def _pair(study: Study, v: Variant) -> list[Model]:
    outcome, cluster = study.outcome if v.outcome is None else v.outcome, v.cluster or study.cluster
    return [Model(f"{v.name}|primary", (study.group, *v.controls), outcome, v.rows, cluster),
            Model(f"{v.name}|secondary", (*study.pairs, *v.controls), outcome, v.rows, cluster)]


def fit_variants(df: DataFrame, study: Study, variants: Sequence[Variant],
                 extra: Mapping[str, Column] = {}, strict: bool = True) -> list[Fit]:
    """L13, L16, L18, L19. Both models of every variant, all in the same passes over the data."""
    return fit_logits(df, study.terms(extra), [m for v in variants for m in _pair(study, v)], strict)


def variant_table(df: DataFrame, study: Study, fits: Sequence[Fit]) -> DataFrame:
    """L7, L20. (variant, comparison, rows, late, odds ratio, interval, p, side): one row per comparison."""
    rows = []
    for f in fits:
        variant, kind = f.name.split("|")
        wanted = {study.group: f"{study.base} vs rest"} if kind == "primary" else study.pairs
        if not f.converged:
            rows += [(variant, label, f.n, f.hits, None, None, None, None) for label in wanted.values()]
            continue
        rows += [(variant, wanted[r["term"]], f.n, f.hits, r["odds_ratio"], r["ci_low"], r["ci_high"], r["p_value"])
                 for r in odds_ratios(f, list(wanted))]
    schema = ("variant STRING, comparison STRING, rows DOUBLE, late DOUBLE, odds_ratio DOUBLE, ci_low DOUBLE,"
              " ci_high DOUBLE, p_value DOUBLE")
    return df.sparkSession.createDataFrame(rows, schema).withColumn("side", interval_side("ci_low", "ci_high"))


def leave_one_out(df: DataFrame, study: Study, batch: str) -> DataFrame:
    """L14. Refits without one batch each: smallest and largest odds ratio per comparison."""
    models = [Model("primary", (study.group, *study.controls), study.outcome), Model("secondary", (*study.pairs, *study.controls), study.outcome)]
    wanted = [("primary", study.group, f"{study.base} vs rest"), *[("secondary", term, label) for term, label in study.pairs.items()]]
    names = df.sparkSession.createDataFrame(wanted, "model STRING, term STRING, comparison STRING")
    return leave_out_fits(df, study.terms(), models, batch).join(F.broadcast(names), ["model", "term"]).groupBy("comparison").agg(
        F.min("odds_ratio").alias("smallest"), F.max("odds_ratio").alias("largest"), F.count(F.lit(1)).alias("fits"))


def lateness_grid(study: Study, delay: str, cuts: Mapping[str, tuple[int, int]]) -> list[Variant]:
    """L18, B33. One variant per (cut-off, cut-off of the group)."""
    return [Variant(name, tuple(study.controls), outcome=F.coalesce(
        F.col(delay) >= F.when(F.col(study.group) == 1, F.lit(own)).otherwise(F.lit(cut)), F.lit(False)).cast("int"))
        for name, (cut, own) in cuts.items()]


def shift_grid(study: Study, delay: str, shifts: Sequence[int] = tuple(range(-4, 5)), cuts: Sequence[int] = (5, 10, 15, 20),
               controls: Sequence[str] | None = None, label: str = "") -> list[Variant]:
    """L18. Every cut-off with every shift of the group: the group is late at ``cut - shift`` or more, the others at ``cut``."""
    grid = lateness_grid(study, delay, {f"late at {c}, shift {k:+d}{label}": (c, c - k) for c in cuts for k in shifts})
    return grid if controls is None else [replace(v, controls=tuple(controls)) for v in grid]


def cross_controls(samples: Sequence[Variant], versions: Mapping[str, tuple[Mapping[str, str], Sequence[str]]]) -> list[Variant]:
    """L19. Every sample with every version of the model: version name -> (inputs to swap, inputs to leave out)."""
    return [replace(v, name=f"{v.name} / {name}", controls=tuple(swap.get(c, c) for c in v.controls if c not in drop))
            for v in samples for name, (swap, drop) in versions.items()]


def model_versions(wind: str = "weather_wind_speed", retimed: str = "wind_at_schedule") -> dict[str, tuple[dict, tuple]]:
    """L16, L19. The three versions of the study's models: wind at landing, wind at the scheduled arrival, no wind."""
    return {"wind at landing": ({}, ()), "wind at schedule": ({wind: retimed}, ()), "no wind": ({}, (wind,))}


def effect_table(df: DataFrame, study: Study, variants: Sequence[Variant], extra: Mapping[str, Column] = {}, strict: bool = True) -> DataFrame:
    """L7, L8, L18-L20. ``variant_table`` with the average marginal effect of every comparison.

    One set of passes fits all models of the grid and one more adds up all effects. A model that does not fit has NULL results.
    """
    fits = fit_variants(df, study, variants, extra, strict)
    rows_of = {f"{v.name}|{kind}": v.rows for v in variants for kind in ("primary", "secondary")}
    asked, labels, rows = [], [], []
    for f in fits:
        variant, kind = f.name.split("|")
        wanted = {study.group: f"{study.base} vs rest"} if kind == "primary" else study.pairs
        for term, comparison in wanted.items() if f.converged else ():
            asked.append((f, term, [t for t in wanted if t != term]))
            labels.append((variant, comparison))
            rows.append(rows_of[f.name])
    found = marginal_effects(df, study.terms(extra), asked, rows) if asked else []
    effects = df.sparkSession.createDataFrame(
        [(*label, e["effect"], e["ci_low"], e["ci_high"]) for label, e in zip(labels, found)],
        "variant STRING, comparison STRING, effect DOUBLE, effect_low DOUBLE, effect_high DOUBLE")
    return variant_table(df, study, fits).join(F.broadcast(effects), ["variant", "comparison"], "left")


def primary_holds() -> Column:
    """L12. The group is later: odds ratio and both lower bounds above 1."""
    return F.coalesce((F.col("odds_ratio") > 1) & (F.col("ci_low") > 1) & (F.col("boot_low") > 1), F.lit(False))


def pairwise_verdict(base: str, alpha: float = 0.05) -> Column:
    """L12. Direction, adjusted p-value and bootstrap interval must agree."""
    sure = F.col("holm_p") < alpha
    return (F.when((F.col("odds_ratio") < 1) & sure & (F.col("boot_high") < 1), F.lit(f"{base} is later"))
            .when((F.col("odds_ratio") > 1) & sure & (F.col("boot_low") > 1), F.lit(f"this one is later than {base}"))
            .otherwise(F.lit(f"not distinguishable from {base}")))


def study_summary(df: DataFrame, study: Study, stratum: str, reps: int = 999, seed: int = 2026) -> tuple[DataFrame, dict]:
    """L5-L12. Estimates, clustered and bootstrap intervals, adjusted p-values and verdicts."""
    controls = tuple(study.controls)
    table = variant_table(df, study, fit_variants(df, study, [Variant("main", controls)]))
    boot = cluster_bootstrap(df, study.terms(), study.outcome, {
        "primary": (study.group, *controls), "secondary": (*study.pairs, *controls)}, stratum, study.cluster, reps, seed)
    rows = [(f"{study.base} vs rest", *draw_interval(boot, "primary", study.group)),
            *[(label, *draw_interval(boot, "secondary", term)) for term, label in study.pairs.items()]]
    intervals = df.sparkSession.createDataFrame(rows, "comparison STRING, boot_low DOUBLE, boot_high DOUBLE")
    is_primary = F.col("comparison") == f"{study.base} vs rest"
    joined = holm(table.join(intervals, "comparison", "left").withColumn("family", is_primary), "p_value", ["family"])
    verdict = F.when(is_primary, F.when(primary_holds(), f"{study.base} is later").otherwise(
        f"not distinguishable from {study.base}")).otherwise(pairwise_verdict(study.base))
    return joined.withColumn("verdict", verdict).drop("family"), boot


def robust_claims(summary: DataFrame, variants: DataFrame, loo: DataFrame, base: str, interval_checks: Sequence[str],
                  direction_checks: Sequence[str]) -> DataFrame:
    """L15. A claim is robust if its interval excludes 1 in some checks and its direction holds in all.

    A claim that failed to fit anywhere is not robust.
    """
    claims = summary.where(~F.col("verdict").startswith("not distinguishable")).select(
        "comparison", "verdict", F.when(F.col("odds_ratio") > 1, 1).otherwise(-1).alias("direction"))
    checked = variants.join(claims, "comparison").groupBy("comparison").agg(
        F.count_if(F.col("variant").isin(*interval_checks) & (F.col("side") == F.col("direction"))).alias("_sides"),
        F.count_if(F.col("variant").isin(*direction_checks) & F.when(
            F.col("direction") == 1, F.col("odds_ratio") > 1).otherwise(F.col("odds_ratio") < 1)).alias("_ways"))
    holds = F.when(F.col("direction") == 1, F.col("smallest") > 1).otherwise(F.col("largest") < 1)
    return claims.join(checked, "comparison", "left").join(loo, "comparison", "left").select(
        "comparison", "verdict", F.coalesce(
            (F.col("_sides") == len(interval_checks)) & (F.col("_ways") == len(direction_checks)) & holds,
            F.lit(False)).alias("robust"))
