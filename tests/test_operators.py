from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctua import operators as O

T0 = datetime(2026, 9, 1)


def naive_asof(left, right, tolerance=None):
    out = []
    for i, k, t in left:
        best = [r for r in right if r[0] == k and k is not None and t is not None and r[1] <= t]
        hit = max(best, key=lambda r: r[1]) if best else None
        if hit and tolerance is not None and (t - hit[1]).total_seconds() > tolerance:
            hit = None
        out.append((i, hit[1] if hit else None, hit[2] if hit else None))
    return sorted(out)


def run_asof(spark, left, right, **kw):
    a = spark.createDataFrame(left, "i INT, k STRING, t TIMESTAMP_NTZ")
    b = spark.createDataFrame(right, "k STRING, seen TIMESTAMP_NTZ, v INT")
    return sorted(tuple(r) for r in O.asof_join(a, b, ["k"], "t", "seen", ["v"], **kw).select("i", "seen", "v").collect())


def test_asof_edges(spark):
    right = [("a", T0, 1), ("a", T0 + timedelta(days=90), 2)]
    left = [(1, "a", T0), (2, "a", T0 - timedelta(seconds=1)), (3, "a", T0 + timedelta(days=400)), (4, "b", T0),
            (5, None, T0), (6, "a", None), (7, "a", T0 + timedelta(days=80)), (8, "a", T0 + timedelta(days=80))]
    assert run_asof(spark, left, right) == naive_asof(left, right)
    assert run_asof(spark, left, right, tolerance_seconds=0) == naive_asof(left, right, 0)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 500_000)), min_size=1, max_size=40),
       st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 500_000)), min_size=1, max_size=40, unique=True),
       st.sampled_from([(600, 4), (3600, 1024), (7, 3)]))
def test_asof_equals_the_naive_answer(spark, arrivals, seen, sizes):
    left = [(i, k, T0 + timedelta(seconds=s)) for i, (k, s) in enumerate(arrivals)]
    right = [(k, T0 + timedelta(seconds=s), i) for i, (k, s) in enumerate(seen)]
    assert run_asof(spark, left, right, bucket_seconds=sizes[0], fan=sizes[1]) == naive_asof(left, right)


def test_probes_equal_one_join_each(spark):
    right = [(k, T0 + timedelta(minutes=m), i) for i, (k, m) in enumerate([("a", 0), ("a", 45), ("a", 9000), ("b", 30)])]
    left = [(1, "a", T0, T0 + timedelta(minutes=50)), (2, "a", T0 - timedelta(seconds=1), None), (3, "b", T0 + timedelta(days=9), T0 + timedelta(minutes=31)),
            (4, None, T0, T0), (5, "a", None, T0 + timedelta(days=30)), (6, "a", T0 + timedelta(minutes=50), T0), (6, "a", T0 + timedelta(minutes=50), T0), (7, "c", T0, T0)]
    a = spark.createDataFrame(left, "i INT, k STRING, t TIMESTAMP_NTZ, u TIMESTAMP_NTZ")
    b = spark.createDataFrame(right, "k STRING, seen TIMESTAMP_NTZ, v INT")
    both = O.asof_probes(a, b, ["k"], "seen", [O.Probe("t", {"t_seen": "seen", "t_v": "v"}), O.Probe("u", {"u_v": "v"}, 300)])
    got = both.collect()
    assert both.columns == ["i", "k", "t", "u", "t_seen", "t_v", "u_v"]
    assert sorted((r.i, r.t_seen, r.t_v) for r in got) == naive_asof([(i, k, t) for i, k, t, _ in left], right)
    assert sorted((r.i, r.u_v or -1) for r in got) == sorted(
        (i, v or -1) for i, _, v in naive_asof([(i, k, u) for i, k, _, u in left], right, 300))
    assert O.asof_probes(a.limit(0), b, ["k"], "seen", [O.Probe("t", {"v": "v"}), O.Probe("u", {"w": "v"})]).count() == 0


def test_probes_read_the_right_side_once(spark, tmp_path):
    spark.range(2000).selectExpr("id % 5 as k", "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, cast(id as int)) as seen", "id as v").write.parquet(f"{tmp_path}/r")
    spark.range(900).selectExpr("id % 5 as k", "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, cast(2 * id as int)) as t",
                                "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, cast(id as int)) as u").write.parquet(f"{tmp_path}/l")
    right, left = spark.read.parquet(f"{tmp_path}/r"), spark.read.parquet(f"{tmp_path}/l")
    df = O.asof_probes(left, right, ["k"], "seen", [O.Probe("t", {"v": "v"}), O.Probe("u", {"w": "v"})])
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count(f"{tmp_path}/r") == 1


def test_asof_keeps_rows_that_share_a_time(spark):
    left = [(i, "hot", T0 + timedelta(hours=1)) for i in range(500)]
    got = run_asof(spark, left, [("hot", T0, 7)])
    assert len(got) == 500 and {g[2] for g in got} == {7}


def test_latest_by_treats_null_keys_as_one_group_and_sorts_nulls_last(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", None, "p"), ("a", 1, "q")], "k STRING, o INT, v STRING")
    got = O.latest_by(df, ["k"], [F.desc_nulls_last("o")])
    assert sorted((r.k or "", r.v) for r in got.collect()) == [("", "y"), ("a", "q")]


def test_collapse_counts_and_keeps_the_first(spark):
    df = spark.createDataFrame([("o", "L2", 2), ("o", "L1", 1), ("o", None, 3), ("p", None, 4)], "k STRING, l STRING, v INT")
    got = {r.k: (r.l, r.v, r.n) for r in O.collapse_with_count(df, ["k"], ["l"], "n").collect()}
    assert got == {"o": ("L1", 1, 3), "p": (None, 4, 1)}


def test_quantiles_match_pandas_with_null_groups_and_outliers(spark):
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 3 + [None] * 4,
                        "v": [float(i % 7) for i in range(49)] + [1e9] + [3.5, 3.5, 9.0] + [1.0, None, 2.0, 5.0]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "g STRING, v DOUBLE")
    got = {r.g: (r.lo, r.mid) for r in O.quantiles(df, "v", [0.1, 0.5], ["g"], ["lo", "mid"]).collect()}
    for g, part in [("a", pdf.v[pdf.g == "a"]), ("b", pdf.v[pdf.g == "b"]), (None, pdf.v[pdf.g.isna()])]:
        assert got[g] == pytest.approx((part.quantile(0.1), part.quantile(0.5)))
    assert O.quantiles(df.where("v < 0"), "v", [0.5]).count() == 0


def test_join_ranked_folds_and_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbccd"] + [(None,)], "c STRING")
    got = {r.c: r["rank"] for r in O.join_ranked(df, "c", 2).distinct().collect()}
    assert got == {"a": 1, "b": 2, "c": 3, "d": 3}


def test_distinct_pairs_ignore_nulls(spark):
    df = spark.createDataFrame([("k", 1, 1), ("k", 1, None), ("k", 2, 1), ("k", 1, 1), ("z", None, None)], "k STRING, a INT, b INT")
    assert {r.k: r.n for r in O.distinct_count(df, ["k"], ["a", "b"], "n").collect()} == {"k": 2, "z": 0}


def test_outside_and_members(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k STRING")
    seen = spark.createDataFrame([("a",)], "s STRING")
    assert [r.k for r in O.missing_members(df, seen, "k", "s").collect()] == ["b"]
    marked = {r.k: r.m for r in O.mark_members(df, seen, "k", "s", "m").collect()}
    assert marked == {"a": True, "b": False, None: False}


def test_rare_and_sample_guards(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",), (None,)], "c STRING")
    assert {(r.c, r.g) for r in O.rare_to_other(df, "c", min_count=2, name="g").collect()} == {
        ("a", "a"), ("b", "Other"), (None, "Other")}
    O.assert_sample(df, {"n": 5}, {"n": F.count(F.lit(1))})
    with pytest.raises(AssertionError):
        O.assert_sample(df, {"n": 4}, {"n": F.count(F.lit(1))})


def test_plans_hold_no_cross_join_and_no_broadcast_hint(spark):
    left = spark.createDataFrame([(1, "a", T0)], "i INT, k STRING, t TIMESTAMP_NTZ")
    right = spark.createDataFrame([("a", T0, 1)], "k STRING, seen TIMESTAMP_NTZ, v INT")
    plan = O.asof_join(left, right, ["k"], "t", "seen", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan and "Cartesian" not in plan and "Join Cross" not in plan


def test_carry_forward_never_looks_ahead_inside_a_tie(spark):
    t = datetime(2026, 9, 1)
    rows = [("a", t, 1, 5.0), ("a", t + timedelta(hours=1), 2, None), ("a", t + timedelta(hours=1), 3, 7.0), ("a", t + timedelta(hours=1), 4, None),
            ("a", t + timedelta(hours=2), 5, None), ("b", t, 6, None)]
    got = O.carry_forward(spark.createDataFrame(rows, "k STRING, at TIMESTAMP_NTZ, id INT, v DOUBLE"), ["k"], "at", "v", "id", "last").orderBy("id").collect()
    assert [r.last for r in got] == [5.0, 5.0, 7.0, 7.0, 7.0, None]
