import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctua import stats as S
from punctua.stats import bootstrap, left_out
from punctua.stats.study import Variant


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 1500
    place = rng.choice(["ATL", "EWR", "SFO"], n)
    pull = rng.integers(0, 8, n)
    pdf = pd.DataFrame({"place": place, "pull": pull, "batch": [f"{p}{b}" for p, b in zip(place, pull)],
                        "night": rng.integers(0, 2, n), "wind": np.round(rng.gamma(3, 3, n)),
                        "sfo": (place == "SFO").astype(int)})
    shock = rng.normal(0, 0.3, (3, 8))[pd.factorize(place)[0], pull]
    eta = -1.2 + 0.8 * pdf.sfo - 0.5 * pdf.night + 0.02 * pdf.wind + shock
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    return pdf, spark.createDataFrame(pdf).repartition(3).cache()


def terms():
    return {**S.number("sfo"), **S.number("night"), **S.number("wind")}


def numpy_fit(x, y, groups=None, w=None):
    w = np.ones(len(y)) if w is None else w
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        h = x.T @ (x * (w * p * (1 - p))[:, None])
        b = b + np.linalg.solve(h, x.T @ (w * (y - p)))
    if groups is None:
        return b, None
    p = 1 / (1 + np.exp(-x @ b))
    s = pd.DataFrame(x * (y - p)[:, None]).groupby(np.asarray(groups)).sum().to_numpy()
    g, (n, k), hi = len(s), x.shape, np.linalg.inv(h)
    return b, hi @ (s.T @ s) @ hi * g / (g - 1) * (n - 1) / (n - k)


def design(pdf, *cols):
    return np.column_stack([np.ones(len(pdf)), *[pdf[c] for c in cols]]).astype(float)


def test_fit_and_clustered_errors_match_numpy(sample):
    pdf, df = sample
    fit = S.fit_logit(df, terms(), "y", "batch")
    b, cov = numpy_fit(design(pdf, "sfo", "night", "wind"), pdf.y.to_numpy(), pdf.batch)
    assert fit.params == pytest.approx(b, abs=1e-8) and fit.cov == pytest.approx(cov, abs=1e-8)
    assert (fit.clusters, fit.n, fit.hits) == (24, 1500, pdf.y.sum())
    r = S.odds_ratios(fit, ["sfo"])[0]
    z = fit.at("sfo") / math.sqrt(cov[1, 1])
    assert r["p_value"] == pytest.approx(2 * (1 - NormalDist().cdf(abs(z))), abs=1e-9)


def test_marginal_effect_matches_finite_differences(sample):
    pdf, df = sample
    fit = S.fit_logit(df, terms(), "y", "batch")
    on, off = design(pdf.assign(sfo=1), "sfo", "night", "wind"), design(pdf.assign(sfo=0), "sfo", "night", "wind")
    at = lambda b: (1 / (1 + np.exp(-on @ b)) - 1 / (1 + np.exp(-off @ b))).mean()
    grad = np.array([(at(fit.params + e) - at(fit.params - e)) / 2e-6 for e in 1e-6 * np.eye(4)])
    got = S.average_marginal_effect(df, terms(), fit, "sfo")
    assert (got["effect"], got["se"]) == pytest.approx((at(fit.params), math.sqrt(grad @ fit.cov @ grad)), rel=1e-5)


def test_effects_of_many_models_in_one_pass_match_finite_differences(sample):
    pdf, df = sample
    levels = S.factor("place", ["ATL", "EWR", "SFO"], "SFO")
    inputs = {**S.number("sfo"), **levels, **S.number("night"), **S.number("wind")}
    calm = F.col("wind") < 10
    models = [S.Model("one", ("sfo", "night"), F.col("y"), None, "batch"), S.Model("two", (*levels, "wind"), F.col("y"), calm, "batch")]
    one, two = S.fit_logits(df, inputs, models)
    asked = [(one, "sfo", ()), (two, "place[ATL]", ["place[EWR]"]), (two, "place[EWR]", ["place[ATL]"])]
    got = S.marginal_effects(df, inputs, asked, [None, calm, calm])
    base = pdf.assign(ATL=(pdf.place == "ATL").astype(int), EWR=(pdf.place == "EWR").astype(int))
    windless = base[base.wind < 10]
    cases = [(one, design(base.assign(sfo=1), "sfo", "night"), design(base.assign(sfo=0), "sfo", "night")),
             (two, design(windless.assign(ATL=1, EWR=0), "ATL", "EWR", "wind"), design(windless.assign(ATL=0, EWR=0), "ATL", "EWR", "wind")),
             (two, design(windless.assign(ATL=0, EWR=1), "ATL", "EWR", "wind"), design(windless.assign(ATL=0, EWR=0), "ATL", "EWR", "wind"))]
    for (fit, on, off), found in zip(cases, got):
        at = lambda b: (1 / (1 + np.exp(-on @ b)) - 1 / (1 + np.exp(-off @ b))).mean()  # noqa: B023, E731
        grad = np.array([(at(fit.params + e) - at(fit.params - e)) / 2e-6 for e in 1e-6 * np.eye(len(fit.params))])
        assert (found["effect"], found["se"]) == pytest.approx((at(fit.params), math.sqrt(grad @ fit.cov @ grad)), rel=1e-5)


def test_grids_cross_samples_versions_cuts_and_shifts(sample):
    pdf, df = sample
    study = S.Study("sfo", "place", ("ATL", "EWR", "SFO"), "SFO", F.col("y"), {**S.number("night"), **S.number("wind")}, "batch")
    samples = [Variant("all", ("night", "wind")), Variant("calm", ("night", "wind"), F.col("wind") < 10)]
    crossed = S.cross_controls(samples, {"as is": ({}, ()), "swapped": ({"wind": "pull"}, ()), "none": ({}, ("wind",))})
    assert [(v.name, v.controls) for v in crossed][:3] == [
        ("all / as is", ("night", "wind")), ("all / swapped", ("night", "pull")), ("all / none", ("night",))]
    table = {(r.variant, r.comparison): r for r in S.effect_table(df, study, crossed, S.number("pull")).collect()}
    assert len(table) == 18 and all(r.effect_low < r.effect < r.effect_high for r in table.values())
    b, _ = numpy_fit(design(pdf, "sfo", "night", "pull"), pdf.y.to_numpy())
    assert table[("all / swapped", "SFO vs rest")].odds_ratio == pytest.approx(math.exp(b[1]), rel=1e-7)
    cells = S.shift_grid(study, "wind", shifts=(-1, 0, 2), cuts=(5, 9))
    assert [v.name for v in cells] == [f"late at {c}, shift {k:+d}" for c in (5, 9) for k in (-1, 0, 2)]
    late = df.select(F.sum(cells[2].outcome)).first()[0]
    assert late == int(np.where(pdf.sfo == 1, pdf.wind >= 3, pdf.wind >= 5).sum())


def test_vif_is_the_inverse_correlation(sample):
    pdf, df = sample
    want = np.diag(np.linalg.inv(np.corrcoef(design(pdf, "sfo", "night", "wind")[:, 1:].T)))
    assert list(S.vif(df, terms()).values()) == pytest.approx(want)


def test_missing_inputs_and_separation_stop_the_fit(spark, sample):
    _, df = sample
    with pytest.raises(S.FitFailed, match="missing"):
        S.fit_logit(df.withColumn("wind", F.when(F.col("wind") > 5, F.col("wind"))), terms(), "y")
    perfect = spark.createDataFrame([(i % 2, i % 2, str(i)) for i in range(20)], "x INT, y INT, c STRING")
    with pytest.raises(S.FitFailed):
        S.fit_logit(perfect, S.number("x"), "y")


def test_bootstrap_draws_keep_strata_sizes_and_refit_like_numpy(sample):
    pdf, df = sample
    draws = {k: np.zeros(30) for k in set(pdf.batch)}
    for r in S.batch_draws(df, "place", "batch", 30, 5).collect():
        draws[r.batch][r.rep] = r.n
    for p in ("ATL", "EWR", "SFO"):
        total = sum(v for k, v in draws.items() if k.startswith(p))
        assert (total == 8).all()
    boot = S.cluster_bootstrap(df, terms(), F.col("y"), {"main": list(terms())}, "place", "batch", 30, 5)
    assert boot["failed"] == 0 and boot["reliable"]
    w = pdf.batch.map(lambda b: draws.get(b, np.zeros(30))[3]).to_numpy(float)
    b, _ = numpy_fit(design(pdf, "sfo", "night", "wind"), pdf.y.to_numpy(), w=w)
    assert [d["sfo"] for d in boot["draws"] if d["rep"] == 3] == pytest.approx([b[1]], abs=1e-7)
    again = S.cluster_bootstrap(df.repartition(5), terms(), F.col("y"), {"main": list(terms())}, "place", "batch", 30, 5)
    assert [d["sfo"] for d in again["draws"]] == pytest.approx([d["sfo"] for d in boot["draws"]], abs=1e-9)


def test_study(sample, monkeypatch):
    pdf, df = sample
    study = S.Study("sfo", "place", ("ATL", "EWR", "SFO"), "SFO", F.col("y"), {**S.number("night"), **S.number("wind")}, "batch")
    table, boot = S.study_summary(df, study, "place", reps=60)
    got = {r.comparison: r for r in table.collect()}
    assert set(got) == {"SFO vs rest", "ATL", "EWR"} and got["SFO vs rest"].odds_ratio > 1
    assert all(r.holm_p >= r.p_value for r in got.values())
    variants = S.variant_table(df, study, S.fit_variants(df, study, [
        Variant("main", ("night", "wind")), Variant("calm", ("night",), F.col("wind") < 8)]))
    calm = pdf[pdf.wind < 8]
    b, cov = numpy_fit(design(calm, "sfo", "night"), calm.y.to_numpy(), calm.batch)
    row = variants.where("variant = 'calm' and comparison = 'SFO vs rest'").first()
    assert (row.odds_ratio, row.rows) == (pytest.approx(math.exp(b[1])), len(calm))
    assert row.ci_low == pytest.approx(math.exp(b[1] - S.intervals.Z95 * math.sqrt(cov[1, 1])))
    monkeypatch.setattr(left_out, "BATCHES", 3)  # several blocks of batches
    left = {r.comparison: r for r in S.leave_one_out(df, study, "pull").collect()}
    assert {r.fits for r in left.values()} == {8}
    wants = [math.exp(numpy_fit(design(p, "sfo", "night", "wind"), p.y.to_numpy())[0][1])
             for p in (pdf[pdf.pull != k] for k in range(8))]
    assert (left["SFO vs rest"].smallest, left["SFO vs rest"].largest) == pytest.approx((min(wants), max(wants)))


def test_verdict_rules(spark):
    rows = [("a", 0.5, 0.01, 0.3, 0.9), ("b", 0.5, 0.01, 0.3, 1.1), ("c", 2.0, 0.01, 1.1, 3.0), ("d", 2.0, 0.2, 1.1, 3.0)]
    df = spark.createDataFrame(rows, "comparison STRING, odds_ratio DOUBLE, holm_p DOUBLE, boot_low DOUBLE, boot_high DOUBLE")
    got = {r.comparison: r.v for r in df.select("comparison", S.pairwise_verdict("SFO").alias("v")).collect()}
    assert got == {"a": "SFO is later", "b": "not distinguishable from SFO", "c": "this one is later than SFO",
                   "d": "not distinguishable from SFO"}


def test_two_proportions_and_power(spark):
    df = spark.createDataFrame([("SFO", 52, 275), ("ATL", 30, 270)], "g STRING, late INT, rows INT")
    r = S.two_proportion_z(df, "g", "SFO").first()
    pool = 82 / 545
    z = (52 / 275 - 30 / 270) / math.sqrt(pool * (1 - pool) * (1 / 275 + 1 / 270))
    assert (r.z, r.p_value) == pytest.approx((z, 2 * (1 - NormalDist().cdf(z))))
    w = S.wilson_interval(spark.createDataFrame([(85, 437)], "late INT, rows INT")).first()
    assert (round(w.ci_low, 3), round(w.ci_high, 3)) == (0.160, 0.234)
    assert S.power(1.58, 0.86, 2.90, 1.1) == pytest.approx(0.29, abs=0.02)


def test_the_fixed_checks_run_on_flights(spark):
    from punctua import plans

    rng = np.random.default_rng(3)
    n = 4000
    landed = pd.Timestamp("2026-09-04") + pd.to_timedelta(rng.integers(0, 14, n) * 2, "D") + pd.to_timedelta(
        rng.integers(0, 9 * 60, n), "m")
    late = rng.integers(-40, 40, n)
    names = np.array(["United Airlines", "Delta Air Lines", "American Airlines", "Alaska Airlines (Retro Livery)", "Fedex",
                      "Jetblue", "Netjets", "21 Air", "Airshare", "Abx Air"])
    # Cargo and charter carriers stay under the carrier cut-off, or their term would repeat the cargo flag.
    share = np.array([30, 20, 15, 10, 0.9, 19.1, 2, 1.2, 0.9, 0.9]) / 100
    pdf = pd.DataFrame({
        "flight_date": landed.date, "arrival_airport": rng.choice(["ATL", "EWR", "LAX", "MIA", "SFO"], n),
        "operating_carrier_name": rng.choice(names, n, p=share), "arrival_actual_utc": landed,
        "arrival_scheduled_utc": landed - pd.to_timedelta(late, "m"),
        "departure_scheduled_utc": landed - pd.to_timedelta(rng.integers(60, 400, n), "m"),
        "arrival_scheduled_local": landed - pd.to_timedelta(7 * 60 + late, "m"), "arrival_delay_minutes": late,
        "is_delayed_arrival": late >= 15, "has_suspect_times": False, "weather_wind_speed": rng.gamma(3, 3, n).round()})
    rows = plans.study_rows(plans.prepare(spark.createDataFrame(pdf))).cache()
    study = S.delay_study()
    checks, extra = S.delay_checks(rows, study)
    grid, more = S.delay_operator_grid(study)
    found = S.fit_variants(rows, study, [*checks, *grid], {**extra, **more}, strict=False)
    assert not [(f.name, f.n, f.hits, f.steps, f.terms) for f in found if not f.converged]
    fits = {f.name: f for f in found}
    sizes = rows.agg(F.count_if("in_sample").alias("main"), F.count_if(F.col("in_window") & F.col("scheduled_operator")).alias("r7"),
                     F.count_if(F.col("in_sample") & (F.col("cargo") == 0)).alias("r3")).first()
    assert fits["main|primary"].n == sizes.main == plans.model_sample(plans.prepare(spark.createDataFrame(pdf))).count()
    assert (fits["R7 no 2-hour filter|primary"].n, fits["R3 passenger only|secondary"].n) == (sizes.r7, sizes.r3)
    assert fits["R6 + manual pulls (no wind)|primary"].n > sizes.main
    assert any(t.startswith("pull[") for t in fits["R4 + pull indicators|primary"].terms)
    assert "carrier[Jetblue]" in fits["R8 lower carrier cut-off|primary"].terms and len(fits) == 24


def test_an_unlisted_level_is_refused(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "g STRING")
    terms = S.factor("g", ["a", "b"], "a")
    assert [r[0] for r in df.select(*[c.alias(n) for n, c in terms.items()]).collect()] == [0.0, 1.0, None]
    with pytest.raises(Exception, match="not a listed level"):
        df.union(spark.createDataFrame([("c",)], "g STRING")).select(*[c.alias(n) for n, c in terms.items()]).collect()


def test_a_batch_that_the_rest_cannot_do_without(spark):
    rows = [(i % 2, (i // 2) % 2, "a") for i in range(40)] + [(1, 1, "b"), (0, 1, None)]
    df = spark.createDataFrame([r for r in rows if r[0] or r[1] == 0 or r[2] is None], "x INT, y INT, batch STRING")
    got = {r.batch: r for r in S.leave_out_fits(df, S.number("x"), [S.Model("m", ("x",), F.col("y"))], "batch").collect()}
    assert got["a"].odds_ratio is None  # what stays is all late
    k = [(r.x, r.y) for r in df.where("batch is null or batch <> 'b'").collect()]
    n = lambda x, y: k.count((x, y))
    assert got["b"].odds_ratio == pytest.approx(n(1, 1) * n(0, 0) / (n(1, 0) * n(0, 1))) and got["b"].rows == len(k)


def test_the_mixing_function_is_one_in_columns_arrays_and_numbers(spark):
    x = np.array([0, 1, 12345, 2**32 - 1], dtype=np.int64)
    column = [r[0] for r in spark.createDataFrame([(int(v),) for v in x], "x BIGINT").select(bootstrap.mixed(F.col("x"))).collect()]
    assert column == bootstrap.mixed(x).tolist() == [bootstrap.mixed(int(v)) for v in x]


def test_study_rows_are_joined_once(spark, tmp_path):
    """Every pass of a study reads the written rows; none joins line items and orders again."""
    from punctua.catalog.registry import Tables
    from punctua.catalog.statistics import _late_lines, _lateness

    spark.sql("""select * from values (1L, 'R', 'O', 0.07D, 33.0D, 0.04D, timestamp_ntz'2024-01-20 00:00:00'), (1L, 'A', 'F', 0.0D, 5.0D, 0.1D, null),
        (2L, null, 'F', 0.02D, null, 0.0D, timestamp_ntz'2024-02-03 00:00:00'), (2L, null, 'F', 0.02D, null, 0.0D, timestamp_ntz'2024-02-03 00:00:00'),
        (null, 'N', 'O', 0.01D, 1.0D, 0.0D, timestamp_ntz'2024-02-03 00:00:00')
        as t(l_orderkey, l_returnflag, l_linestatus, l_tax, l_quantity, l_discount, l_shipdate)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("""select * from values (1L, timestamp_ntz'2024-01-02 00:00:00', '1-URGENT'), (2L, timestamp_ntz'2024-02-01 00:00:00', null)
        as t(o_orderkey, o_orderdate, o_orderpriority)""").write.parquet(f"{tmp_path}/orders.parquet")
    t = Tables(spark, str(tmp_path))
    rows, _ = _lateness(t)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    direct = _late_lines(t)
    assert rows.columns == direct.columns and sorted(map(repr, rows.collect())) == sorted(map(repr, direct.collect())) and rows.count() == 4
