import math

import numpy as np
import pytest
from helpers import at, panel
from pyspark.sql import functions as F

from seriesloom.functions.scalars import fold_label
from seriesloom.models import smoother, trees
from seriesloom.models.adaboost import AdaBoostModel, AdaBoostR2, BaggedAdaBoost, poisson_weight
from seriesloom.models.search import fold_search

SMALL = {"maxDepth": 2, "minInstancesPerNode": 2}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, size=(300, 2))
    y = np.sin(3 * x[:, 0]) + 0.3 * x[:, 1] + rng.normal(scale=0.05, size=300)
    data = [(i, int(i % 3) - 1, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "id int, fold int, a double, b double, y double")
    return trees.assemble(df, ["a", "b"]).cache()


def rmse(df):
    return math.sqrt(df.agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0])


def test_adaboost_follows_its_recurrence(rows):
    """Votes equal those recomputed on the driver from the fitted trees."""
    model = AdaBoostR2("y", rounds=4, rate=0.5, checkpoint_every=2, **SMALL).fit(rows)
    assert len(model.trees) == 4
    y = np.array([r.y for r in rows.orderBy("id").collect()])
    weights, members = np.ones(len(y)), []
    for tree, vote in zip(model.trees, model.votes):
        pred = np.array([r.prediction for r in tree.transform(rows).orderBy("id").collect()])
        miss = np.abs(y - pred)
        miss = miss / miss.max()
        loss = (weights * miss).sum() / weights.sum()
        beta = loss / (1 - loss)
        assert math.isclose(vote, 0.5 * math.log(1 / beta), rel_tol=1e-9)
        weights = weights * beta ** ((1 - miss) * 0.5)
        members.append(pred)
    members, votes = np.array(members), np.array(model.votes)
    order = members.argsort(axis=0)
    run = votes[order].cumsum(axis=0)
    pick = (run >= 0.5 * votes.sum() - 1e-12).argmax(axis=0)
    expected = np.take_along_axis(members, np.take_along_axis(order, pick[None], 0), 0)[0]
    got = [r.prediction for r in model.transform(rows).orderBy("id").collect()]
    assert np.allclose(got, expected)


def test_adaboost_stops_at_a_perfect_tree(spark):
    df = trees.assemble(spark.createDataFrame([(float(i % 2), float(i % 2)) for i in range(20)], "a double, y double"), ["a"])
    model = AdaBoostR2("y", rounds=5, **SMALL).fit(df)
    assert len(model.trees) == 1
    assert rmse(model.transform(df)) == 0.0


def test_bags_are_reproducible_and_differ(rows):
    def fit():
        return BaggedAdaBoost("y", ["id"], bags=2, rounds=2, **SMALL).fit(rows)

    first, second = fit(), fit()
    one, two = ([r.prediction for r in m.transform(rows).orderBy("id").collect()] for m in (first, second))
    assert one == two
    assert first.members[0].votes != first.members[1].votes
    assert rmse(first.transform(rows)) < 0.6


def test_poisson_weights_have_the_right_moments(spark):
    w = poisson_weight(["id"], 3, 0.7, 1)
    mean, var = spark.range(100_000).select(w.alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(mean - 0.7) < 0.01 and abs(var - 0.7) < 0.02


def test_same_seed_same_importances(rows):
    def fit():
        model = trees.forest("y", numTrees=3, maxDepth=3).fit(rows)
        return trees.importances({"s": model}, ["a", "b"], rows.sparkSession).orderBy("feature").collect()

    first = fit()
    assert first == fit()
    assert math.isclose(sum(r.importance for r in first), 1.0, rel_tol=1e-6)
    assert first[0].importance > first[1].importance


def test_fold_search_trains_without_the_fold(rows):
    """With one-leaf trees the error is that of the other folds' mean."""
    scores = fold_search(rows, "fold", "y", {"stump": trees.forest("y", numTrees=1, maxDepth=0, bootstrap=False)})
    data = [(r.fold, r.y) for r in rows.collect()]
    got = {r.fold: (r.mse, r.n) for r in scores.collect()}
    assert sorted(got) == [0, 1]
    for k, (mse, n) in got.items():
        inside = np.array([y for f, y in data if f == k])
        rest = np.mean([y for f, y in data if f != k])
        assert n == len(inside) and math.isclose(mse, np.mean((inside - rest) ** 2), rel_tol=1e-6)


def test_smoother_against_the_dense_formula(spark):
    rng = np.random.default_rng(4)
    x = np.arange(60.0)
    y = np.sin(x / 8) + rng.normal(scale=0.1, size=60)
    hidden = {7, 20, 59}
    rows = [("a", float(i), None if i in hidden else float(v), 0.5) for i, v in zip(x, y)]
    rows += [("empty", 1.0, None, 0.5), ("one", 3.0, 2.0, 0.5), ("one", 4.0, None, 0.5)]
    df = spark.createDataFrame(rows, "k string, x double, y double, nugget double")
    out = smoother.smooth(df, ["k"], "x", "y", "nugget", [0.1, 10.0, 40.0]).orderBy("x").collect()

    seen = np.array([i not in hidden for i in range(60)])
    u, v = (x - x[seen].mean()) / x[seen].std(), (y - y[seen].mean()) / y[seen].std()

    def fit(theta):
        r = np.exp(-theta * (u[seen][:, None] - u[seen]) ** 2) + 0.5 * np.eye(seen.sum())
        inv, one = np.linalg.inv(r), np.ones(seen.sum())
        mean = one @ inv @ v[seen] / (one @ inv @ one)
        rest = v[seen] - mean
        variance = rest @ inv @ rest / seen.sum()
        return mean, inv @ rest, -math.log(variance) - np.linalg.slogdet(r)[1] / seen.sum()

    theta = max([0.1, 10.0, 40.0], key=lambda t: fit(t)[2])
    mean, dual, _ = fit(theta)
    near = np.exp(-theta * (u[:, None] - u[seen]) ** 2)
    expected = y[seen].mean() + y[seen].std() * (mean + near @ dual)
    got = [r for r in out if r.k == "a"]
    assert {r.theta for r in got} == {theta}
    assert np.allclose([r.y_hat for r in got], expected)
    assert [r.y_hat for r in out if r.k == "empty"] == [None]
    assert np.allclose([r.y_hat for r in out if r.k == "one"], 2.0)


def test_smoother_finds_the_likeliest_length_scale(spark):
    """Within 1 % of a dense search, also where the coarse grid has two peaks or the top lies at an end."""
    rng = np.random.default_rng(8)
    x = np.sort(rng.uniform(0, 50, 60))
    shapes = {
        "slow": np.sin(x / 9), "fast": np.sin(x * 1.2), "both": np.sin(x / 9) + 0.8 * np.sin(x * 1.2), "line": x / 10,
        "noise": rng.normal(size=60),
    }
    values = {k: v + rng.normal(scale=0.1, size=60) for k, v in shapes.items()}
    rows = [(k, float(a), float(b), 0.5) for k, v in values.items() for a, b in zip(x, v)]
    out = smoother.smooth(spark.createDataFrame(rows, "k string, x double, y double, nugget double"), ["k"], "x", "y", "nugget", chunk=25)
    got = {r.k: r.theta for r in out.select("k", "theta").distinct().collect()}
    u = (x - x.mean()) / x.std()
    for k, y in values.items():
        v = (y - y.mean()) / y.std()

        def like(theta):
            r = np.exp(-theta * (u[:, None] - u) ** 2) + 0.5 * np.eye(60)
            inv, one = np.linalg.inv(r), np.ones(60)
            rest = v - one @ inv @ v / (one @ inv @ one)
            return -math.log(rest @ inv @ rest / 60) - np.linalg.slogdet(r)[1] / 60

        dense = np.logspace(-3, 2, 101)
        top = dense[np.argmax([like(t) for t in dense])]
        near = np.clip(top * np.logspace(-0.06, 0.06, 61), 1e-3, 100)
        top = near[np.argmax([like(t) for t in near])]
        assert abs(math.log(got[k] / top)) < 0.01 or like(got[k]) >= like(top)


def test_smoother_takes_groups_of_any_size_and_parts_change_nothing(spark):
    df = spark.range(20_000).selectExpr(
        "if(id % 2 = 0, 'a', NULL) AS k", "double(id) AS x", "if(id % 7 = 3, NULL, sin(id / 900)) AS y", "0.5D AS nugget"
    )
    whole, cut = (
        smoother.smooth(df, ["k"], "x", "y", "nugget", [10.0, 100.0], chunk=c).orderBy("x").collect() for c in (16_384, 1_000)
    )
    assert len(whole) == 20_000
    assert np.allclose([r.y_hat for r in whole], [r.y_hat for r in cut])
    assert np.allclose([r.y_hat for r in whole], np.sin(np.arange(20_000) / 900), atol=0.05)


def test_smoother_solves_groups_of_few_rows_from_their_rows(spark):
    """Equal to the sums of polynomials, with null keys, rows that come twice, one place, one row and constant values."""
    rng = np.random.default_rng(3)
    rows = []
    for k in [*range(24), None]:
        for x in rng.choice(40, 1 + (k or 0), replace=False):
            rows.append((k, float(x), float(rng.normal() + np.sin(x / 5)) if rng.random() < 0.8 else None, 0.5))
    rows += rows[40:60] + [(50, 3.0, 1.0, 0.5), (50, 3.0, 2.0, 0.5), *((51, float(i), 4.0, 2.0) for i in range(9)), (52, None, 1.0, 0.5), (52, 2.0, 1.0, 0.5)]
    for thetas, of in (([10.0], rows), ([0.1], rows), (None, [r for r in rows if r[0] is None or 5 <= r[0] < 24])):  # a flat likelihood has no likeliest scale
        df = spark.createDataFrame(of, "k long, x double, y double, nugget double")
        got, sums = (
            sorted(map(tuple, smoother.smooth(df, ["k"], "x", "y", "nugget", thetas, few=n).collect()), key=str) for n in (smoother.FEW, 0)
        )
        assert len(got) == len(of)
        as_numbers = lambda out: np.array([[np.nan if v is None else v for v in r] for r in out], float)
        assert np.allclose(as_numbers(got)[:, 2], as_numbers(sums)[:, 2], rtol=1e-4, atol=1e-6 if thetas else 2e-3, equal_nan=True)


def test_smoother_takes_many_small_groups(spark):
    """A group's own search took some tenths of a second before: 4,000 took minutes."""
    import time

    df = spark.range(60_000).selectExpr("id % 4000 AS k", "double(id div 4000) AS x", "sin(id) AS y", "0.5D AS nugget")
    began = time.time()
    out = smoother.smooth(df, ["k"], "x", "y", "nugget").agg(F.count("y_hat").alias("n")).first()
    assert out.n == 60_000 and time.time() - began < 90


def test_a_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        trees.assemble(df, ["a", "b"]).collect()


def test_out_of_fold_rows_are_predicted_by_others(spark):
    from seriesloom.plans import learn
    from seriesloom.plans.spec import PanelSpec

    spec = PanelSpec(["k"], segments=["s"], total="n", linear=["temp"], ordinals=[], lags={}, overrides={})
    rows = [("a", at(24 * d), int(d >= 19), 1.0, float(d < 5), 0.0, 0, 1, 0, 1, 0, 0, 0) for d in range(25)]
    cols = "k string, ts timestamp_ntz, data_set int, temp double, log_s_diff double, log_s_trend double, " \
        "holiday int, workingday int, year int, month int, day_of_week int, hour int, weekend int"  # fmt: skip
    df = panel(spark, rows, cols)
    out = learn.out_of_fold(df, spec, lambda label: trees.forest(label, numTrees=1, maxDepth=0, bootstrap=False),
                            fold_label("ts"), [0, 1], "rf")
    preds = [r.log_s_rf_pred for r in out.orderBy("ts").collect()]
    # Days 1-5 are the only ones with residual 1 and must not see themselves.
    assert np.allclose(preds[:5], 0.0)
    assert np.allclose(preds[5:14], 5 / 19) and np.allclose(preds[14:19], 5 / 14)
    assert np.allclose(preds[19:], 5 / 19)


def test_all_trees_score_in_one_projection(rows):
    """Predictions of each tree equal Spark's, and the plan does not grow with the trees."""
    models = [trees.tree("y", "a2", seed=s, maxDepth=s).fit(rows.withColumn("a2", F.lit(1.0) + F.abs("a"))) for s in range(5)]
    from pyspark.ml.functions import vector_to_array

    for i, m in enumerate(models):
        score = trees.score_trees(models, lambda each, i=i: each[:, i])
        both = m.transform(rows).withColumn("ours", score(vector_to_array("features")))
        assert both.where("ours <> prediction").count() == 0
    many = AdaBoostModel(models * 100, [1.0] * 500).transform(rows)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and many.where("prediction IS NULL").count() == 0
    assert many.limit(0).count() == 0


def test_correlations_equal_the_built_in(spark):
    from seriesloom.operators.scoring import correlations

    df = spark.createDataFrame([(1.0, 5, 2.0), (2.0, 5, None), (4.0, 5, 1.0), (None, 5, 3.0), (7.0, 5, -2.5)], "a double, c int, y double")
    got = {(r.y, r.x): r.r for r in correlations(df, ["a", "c"], ["y"]).collect()}
    assert got[("y", "c")] is None
    assert math.isclose(got[("y", "a")], df.agg(F.corr("a", "y")).first()[0], rel_tol=1e-9)
    assert correlations(df.limit(0), ["a"], ["y"]).collect() == []


def test_lag_correlations_equal_those_of_lag_columns(spark):
    """Over series shorter than the lags, null keys, missing values and batches of few rows; no lag column is made."""
    from seriesloom.operators import lags
    from seriesloom.operators.scoring import correlations

    rng = np.random.default_rng(5)
    value = lambda: None if rng.random() < 0.2 else float(rng.integers(0, 30))
    rows = [(k, at(h), value(), value(), value(), value()) for k, n in (("a", 90), ("b", 2), (None, 40), ("c", 1)) for h in range(n)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, a double, b double, y double, z double")
    fan = lags.lag_fan_out(lags.lag_fan_out(df, ["k"], "ts", "a", 5), ["k"], "ts", "b", 5)
    names = [n for c in "ab" for n in [c, *[lags.lag_name(c, k) for k in range(1, 6)]]]
    expected = {(r.y, r.x): r.r for r in correlations(fan, names, ["y", "z"]).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        out = lags.lag_correlations(df, ["k"], "ts", ["a", "b"], ["y", "z"], 5)
        got = {(r.y, r.x): r.r for r in out.collect()}
        assert "_01h_ago" not in out._jdf.queryExecution().executedPlan().toString().replace("sums", "")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.keys() == expected.keys() and all(math.isclose(got[k], expected[k], rel_tol=1e-9) for k in got)


def test_grid_rows_of_a_task_stay_few(spark):
    """Observed rows are dealt to more tasks than others, because they become many rows each (one task a partition before)."""
    from seriesloom.session import spread_by_keys

    df = spark.range(50).withColumn("k", F.col("id"))
    assert spread_by_keys(df, ["k"]).rdd.getNumPartitions() >= 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_fold_search_keeps_what_bags_need(rows):
    scores = fold_search(rows, "fold", "y", {"bags": BaggedAdaBoost("y", ["id"], bags=2, rounds=1, **SMALL)}, keep=["id"])
    assert sorted((r.fold, r.n) for r in scores.collect()) == [(0, 100), (1, 100)]
