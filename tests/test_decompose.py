import math
import random

import numpy as np
import pytest
from helpers import at, panel
from pyspark.sql import functions as F

from seriesloom.operators import linear, predictions, profile, scoring, weighted


def test_shares_sum_to_one_and_skip_zero_totals(spark):
    rows = [("a", at(24 * d + h), 1, float(h + d), 0.0 if d == 2 else 100.0) for d in range(4) for h in range(24)]
    df = panel(spark, rows, "k string, ts timestamp_ntz, workingday int, y double, total double")
    norm = profile.normalise(df, {"y": "total"})
    assert norm.where(F.col("total") == 0).where(F.col("y_norm").isNotNull()).count() == 0
    out = profile.share_profile(norm, ["k"], "ts", {"share": F.col("y_norm")}).collect()
    assert len(out) == 24 and math.isclose(sum(r.share for r in out), 1.0)
    expected = np.array([np.mean([h + d for d in (0, 1, 3)]) for h in range(24)])
    expected = expected / expected.sum()
    assert np.allclose([r.share for r in sorted(out, key=lambda r: r.hour)], expected)


def test_an_hour_absent_from_the_profile_has_no_trend(spark):
    df = panel(spark, [("a", at(h), 1, 10.0) for h in range(3)], "k string, ts timestamp_ntz, workingday int, total double")
    shares = panel(spark, [("a", 1, 0, 0.25), ("a", 1, 1, 0.75)], "k string, workingday int, hour int, share double")
    out = profile.spread_over_day(df, shares, ["k"], "ts", {"trend": ("share", "total")})
    assert [r.trend for r in out.orderBy("ts").collect()] == [2.5, 7.5, 0.0]


def test_recombination_inverts_the_residual(spark):
    rows = [("a", at(h), 3.0 + h, 5.0, 2.0, 4.0) for h in range(4)]
    df = panel(spark, rows, "k string, ts timestamp_ntz, r double, c double, r_trend double, c_trend double")
    df = df.withColumns({"log_r": F.log1p("r"), "log_c": F.log1p("c")})
    df = profile.residual_targets(df, ["r", "c"])
    out = profile.recombine(df, ["r", "c"], residual="log_{}_diff", rounding="half_even")
    assert [r.count_pred for r in out.orderBy("ts").collect()] == [8, 9, 10, 11]


def brute_weighted_median(pairs):
    total, run = sum(w for _, w in pairs), 0.0
    for v, w in sorted(pairs):
        run += w
        if run >= 0.5 * total:
            return v


def test_weighted_median_literal(spark):
    df = spark.createDataFrame([("g", 3.0, 0.2), ("g", 1.0, 0.5), ("g", 2.0, 0.3)], "k string, v double, w double")
    assert weighted.weighted_median(df, ["k"], "v", "w").first()["median"] == 1.0
    row = df.agg(F.collect_list(F.struct(F.col("v").alias("value"), F.col("w").alias("weight"))).alias("e"))
    assert row.select(weighted.weighted_median_of("e")).first()[0] == 1.0


def test_weighted_median_of_skewed_groups_against_brute_force(spark):
    rng = random.Random(11)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 5)}",
             rng.choice([0.0, rng.gauss(0, 1), rng.gauss(0, 1e6), 7.0]), rng.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    for detail in (1, 256):
        out = {r.k: r.median for r in weighted.weighted_median(df, ["k"], "v", "w", detail=detail).collect()}
        assert out == {k: brute_weighted_median([(v, w) for kk, v, w in rows if kk == k]) for k in out}
        assert len(out) == 7


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=200) * 0.1
    rows = [(0, *map(float, a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "data_set int, a double, b double, c double, y double")
    extra = spark.createDataFrame([(1, 1.0, 1.0, 1.0, None), (0, None, 1.0, 1.0, 9.0)], df.schema)
    scored, table = linear.ridge_stack(df.unionByName(extra), {"s": (["a", "b", "c"], "y")}, F.col("data_set") == 0, 2.0)
    expected = np.linalg.solve(x.T @ x + 2.0 * np.eye(3), x.T @ y)
    assert np.allclose([r.coef for r in table.collect()], expected)
    held_out = scored.where(F.col("data_set") == 1).first()["log_s_stack_pred"]
    assert math.isclose(held_out, expected.sum())


def test_a_feature_of_zeros_drops_out_of_the_ridge(spark):
    df = spark.createDataFrame([(0.0, 2.0, 4.0), (0.0, 1.0, 2.0)], "offset double, a double, y double")
    _, table = linear.ridge_stack(df, {"s": (["offset", "a"], "y")}, F.lit(True), 0.0)
    assert np.allclose([r.coef for r in table.collect()], [0.0, 2.0])


def test_one_pass_fold_scores_equal_separate_fits(spark):
    rng = np.random.default_rng(8)
    x, folds = rng.normal(size=(150, 2)), rng.integers(-1, 2, size=150)
    y = x @ [2.0, 1.0] + rng.normal(size=150)
    rows = [("g", int(f), *map(float, a), float(b)) for f, a, b in zip(folds, x, y)]
    df = spark.createDataFrame(rows, "g string, fold int, a double, b double, y double")
    out = linear.ridge_fold_scores(df, ["g"], "fold", ["a", "b"], "y", [0.5, 5.0]).collect()
    assert len(out) == 4
    for r in out:
        inside = folds == r.fold
        coef = np.linalg.solve(x[~inside].T @ x[~inside] + r.alpha * np.eye(2), x[~inside].T @ y[~inside])
        assert math.isclose(r.mse, np.mean((y[inside] - x[inside] @ coef) ** 2), rel_tol=1e-9)
        assert r.n == inside.sum()


def test_scores_and_rankings(spark):
    df = spark.createDataFrame([(0.0, 1.0), (3.0, 1.0), (None, 1.0)], "y double, p double")
    got = scoring.rmsle(df, [], "y", "p").first()
    assert got.n == 2
    assert math.isclose(got.rmsle, math.sqrt((math.log(2) ** 2 + math.log(2) ** 2) / 2))
    folds = spark.createDataFrame([("p", 1.0, 1), ("p", 4.0, 3)], "params string, mse double, n int")
    summary = scoring.cv_summary(folds, ["params"]).first()
    assert (summary.mean_mse, summary.std_mse) == (3.25, 1.5)
    ranks = spark.createDataFrame(
        [("r", "a", 0.1), ("r", "b", 0.9), ("c", "a", 0.7), ("c", "b", 0.3)],
        "segment string, feature string, importance double",
    )
    rows = scoring.ranked_pairs(ranks, ["r", "c"]).orderBy("rank").collect()
    assert [(x.rank, x.r_feature, x.c_feature) for x in rows] == [(1, "b", "a"), (2, "a", "b")]


def test_long_and_wide_predictions_are_inverse(spark):
    df = panel(spark, [("a", at(0), 1.0, None), ("a", at(1), 2.0, 3.0)], "k string, ts timestamp_ntz, m double, n double")
    long = predictions.long_predictions(df, ["k"], "ts", {("m", "s"): "m", ("n", "s"): "n"})
    assert long.count() == 3
    wide = predictions.pivot_predictions(long, ["k"], "ts", ["m", "n"], ["s"]).orderBy("ts").collect()
    assert [(r.log_s_m_pred, r.log_s_n_pred) for r in wide] == [(1.0, None), (2.0, 3.0)]


@pytest.mark.parametrize("shift, scale", [(1.7e9, 1.0), (0.0, 1.5e-7), (-1e300, 1e296)])
def test_weighted_median_narrows_ranges_of_any_place(spark, shift, scale):
    """Values that one logarithmic step holds: no window sees more than ``few`` of a group."""
    df = spark.range(6_000).selectExpr("if(id % 3 = 0, 'a', NULL) AS k", f"{shift}D + id * {scale}D AS v", "double(id % 5) AS w")
    rows = [(r.k, r.v, r.w) for r in df.collect()]
    out = {r.k: r.median for r in weighted.weighted_median(df, ["k"], "v", "w", detail=16, few=20).collect()}
    assert out == {k: brute_weighted_median([(v, w) for kk, v, w in rows if kk == k and w > 0]) for k in ("a", None)}


def test_hourly_trend_reads_its_hours_twice(spark, tmp_path):
    """One narrow pass for the profile, one for the hours; no wide sort for the daily totals."""
    from seriesloom.plans import forecast
    from seriesloom.plans.spec import PanelSpec

    spec = PanelSpec(["k"], segments=["s"], total="s")
    hours = spark.range(240).selectExpr("'a' AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id AS int)) AS ts", "1 AS workingday", "double(id % 24) AS s", "ln(id % 24 + 1) AS log_s")
    hours.write.parquet(str(tmp_path / "hours"))
    days = spark.range(10).selectExpr("'a' AS k", "date_add(date'2024-01-01', cast(id AS int)) AS day", "276D AS s_total")
    days.write.parquet(str(tmp_path / "days"))
    feats, daily = (spark.read.parquet(str(tmp_path / n)) for n in ("hours", "days"))
    out = forecast.residuals(feats, daily, spec)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("log_s#") and plan.count("Window") <= 6
    reads = [line for line in plan.splitlines() if "Relation [" in line]
    assert sum("workingday" in line for line in reads) == 2
    assert all(abs(r.s_trend - r.s) < 1e-9 for r in out.collect())
