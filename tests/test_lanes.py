"""Fits inside tasks against those of the jobs of ``grown``, and the settings that the queries run at."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_grown import data, frame, plain_tree

from queries import grow
from queries import learn as fitted
from seriesloom.models import capped, grown, lanes, trees
from seriesloom.models.adaboost import AdaBoostR2
from seriesloom.models.grown import Caps, Member


def rows_and_nulls(spark, seed=11, n=400):
    x, y = data(seed, n)
    y = y + np.round(np.random.default_rng(seed).normal(size=y.shape) * 8)
    df = frame(spark, x, y).withColumn("y", F.when(F.col("id") % 9 != 4, F.col("y")))
    return df.unionByName(df.where("id < 30")).withColumn("id", F.when(F.col("id") > 5, F.col("id")))  # keys repeat or are missing


def predicted(models, df):
    for i, m in enumerate(models):
        df = m.transform(df, f"p{i}")
    return np.array([[r[f"p{i}"] for i in range(len(models))] for r in df.orderBy("id", "a", "b", "c", "z").collect()])


FITS = {
    "forest": lambda df: capped.forest(df, ["id"], ["y", "z"], 5, Caps(leaves=20, split=8, leaf=4)),
    "drawn features": lambda df: capped.forest(df, ["id"], ["y", "z"], 4, Caps(leaves=20, share=0.67)),
    "boosted": lambda df: capped.boosted(df, ["id"], ["y", "z"], 9, 0.2, Caps(leaves=9, depth=5), part=0.7),
    "adaboost": lambda df: capped.adaboost(df, ["id"], ["y", "z"], 6, 0.3, Caps(leaves=8, split=8, leaf=4)),
    "bags": lambda df: capped.adaboost(df, ["id"], ["y", "z"], 4, 0.3, Caps(leaves=12, split=8, leaf=4), bags=3),
}


@pytest.mark.parametrize("name", FITS)
def test_fits_in_tasks_equal_those_of_jobs(spark, monkeypatch, name):
    df = rows_and_nulls(spark).cache()
    ours = FITS[name](df)
    monkeypatch.setattr(lanes, "IN_TASK", 0)
    jobs = FITS[name](df)
    for a, b in zip(ours, jobs):
        assert len(a.trees) == len(b.trees) and [t.n_leaves for t in a.trees] == [t.n_leaves for t in b.trees]
        assert np.allclose(a.weights, b.weights)
        assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())
    assert np.allclose(predicted(ours, df), predicted(jobs, df))


def test_trees_of_tasks_are_those_of_jobs_to_the_last_bit(spark, monkeypatch):
    """Of values that leave rounding to decide between equal splits."""
    x, y = data(12, 900)
    df = frame(spark, x, y + np.random.default_rng(12).normal(size=y.shape)).withColumn("flat", F.lit(3.0)).drop("features")
    df = trees.assemble(df.withColumn("twin", -F.col("a")), ["flat", "a", "twin", "b", "c"]).cache()
    fits = {
        "forest": lambda: capped.forest(df, ["id"], ["y"], 4, Caps(leaves=60, split=8, leaf=4)),
        "boosted": lambda: capped.boosted(df, ["id"], ["y"], 8, 0.1, Caps(leaves=40, depth=10), part=0.7),
    }
    for fit in fits.values():
        (ours,) = fit()
        with monkeypatch.context() as m:
            m.setattr(lanes, "IN_TASK", 0)
            (jobs,) = fit()
        for a, b in zip(ours.trees, jobs.trees):
            assert all((getattr(a, n) == getattr(b, n)).all() for n in ("feature", "bin", "left", "right", "value", "gain", "rows"))


def test_rounds_in_tasks_need_no_job_each(spark):
    """Each round ran some jobs before: 500 rounds were some 2,500."""
    df, sc, caps = rows_and_nulls(spark), spark.sparkContext, Caps(leaves=6)
    for fit in (capped.boosted, capped.adaboost):
        jobs = []
        for rounds in (2, 12):
            sc.setJobGroup(f"{fit.__name__}{rounds}", "rounds")
            fit(df, ["id"], ["y", "z"], rounds, 0.1, caps)
            jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"{fit.__name__}{rounds}")))
            sc.setJobGroup("", "")
        assert 0 < jobs[0] == jobs[1]


def test_histograms_by_difference_find_the_same_tree(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, (6, 9000)).astype(np.uint8)
    x[2] = 5
    w, y = rng.integers(0, 4, 9000).astype(float), np.round(x[0] * 2.0 - x[3] + rng.normal(size=9000) * 9)
    inside, features = np.flatnonzero(w > 0), np.array([0, 1, 3, 4, 5])
    caps = Caps(leaves=60, split=8, leaf=4)
    monkeypatch.setattr(lanes, "SIBLINGS", 300)
    tree, leaves = lanes.grow_best(x[features], [w, w * y], inside, features, 40, caps, 1, 6)
    stats = np.column_stack((np.ones(len(inside)), w[inside], (w * y)[inside]))
    nodes = grown.grow_branch(np.ascontiguousarray(x.T)[inside], stats, grown._Node(stats.sum(axis=0), 0, 0), 40, caps, 1)
    other = grown._tree(nodes, grown._chosen(nodes, caps)[0])
    assert tree.n_leaves == other.n_leaves == 60
    assert (tree.predict(x.T) == other.predict(x.T)).all()
    assert sorted(np.concatenate(list(leaves.values()))) == inside.tolist()
    assert all((tree.leaf_of(x.T[own]) == leaf).all() for leaf, own in leaves.items())
    expected, _ = plain_tree(x[features].T.astype(float), y[:, None], w, Caps(leaves=6, leaf=4))
    few, _ = lanes.grow_best(x[features], [w, w * y], inside, features, 40, Caps(leaves=6, leaf=4), 1, 6)
    assert np.allclose(few.predict(x.T)[inside], expected[inside])


@pytest.mark.parametrize("joint", [True, False])
def test_trees_that_the_driver_can_not_hold_predict_where_they_grow(spark, monkeypatch, joint):
    df = rows_and_nulls(spark).cache()
    for caps in (Caps(depth=9, share=0.67), Caps(leaves=20, leaf=2)):
        fit = lambda: capped.forest(df, ["id"], ["y", "z"], 6, caps, joint=joint)  # noqa: B023, E731
        read = lambda models: predicted(models, df) if not joint else np.array([(r.p, r.q) for r in models[0].transform(df, ["p", "q"]).orderBy("id", "a", "b", "c", "z").collect()])
        whole = fit()
        with monkeypatch.context() as m:
            m.setattr(capped, "KEPT", 0)
            again = fit()
            assert all(type(x) is capped.Regrown for x in again)
            got = read(again)
            m.setattr(lanes, "IN_TASK", 60_000)  # room for the rows to fit, but not for all to predict at once
            assert np.allclose(read(again), got)
        assert np.allclose(got, read(whole))
        for a, b in zip(again, whole):
            assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())


@pytest.mark.parametrize("in_memory", [40, 20_000])
def test_branches_of_larger_tables_are_stored(spark, monkeypatch, in_memory):
    df = rows_and_nulls(spark).cache()
    caps = Caps(depth=9, share=0.67)
    (whole,) = capped.forest(df, ["id"], ["y", "z"], 5, caps, joint=True)
    monkeypatch.setattr(capped, "KEPT", 0)
    monkeypatch.setattr(lanes, "IN_TASK", 0)
    monkeypatch.setattr(grown, "IN_MEMORY", in_memory)
    (stored,) = capped.forest(df, ["id"], ["y", "z"], 5, caps, joint=True)
    assert type(stored) is capped.Stored
    read = lambda m: np.array([(r.p, r.q) for r in m.transform(df, ["p", "q"]).orderBy("id", "a", "b", "c", "z").collect()])
    assert np.allclose(read(stored), read(whole))


def test_labels_without_rows(spark):
    df = rows_and_nulls(spark).withColumn("y", F.lit(None).cast("double"))
    caps = Caps(leaves=4)
    for models in (capped.forest(df, ["id"], ["y", "z"], 2, caps), capped.boosted(df, ["id"], ["y", "z"], 2, 0.5, caps)):
        assert [t.n_leaves for t in models[0].trees] == [1, 1] and models[1].trees[0].n_leaves == 4
    with pytest.raises(ValueError):
        capped.adaboost(df, ["id"], ["y", "z"], 2, 1.0, caps)


def test_nodes_of_unequal_sizes_are_split_together():
    """Equal to one node at a time, beyond the depth where a node's place is a whole number of 64 bits too."""
    rng = np.random.default_rng(6)
    for n, caps in ((700, Caps(share=0.4)), (700, Caps(split=5, leaf=2)), (9000, Caps(depth=12, share=0.5)), (90, Caps())):
        x = rng.integers(0, 30, (n, 5)).astype(np.uint8)
        stats = np.column_stack([np.ones(n), rng.integers(1, 4, n), rng.normal(size=(n, 2))])
        if n == 90:
            x = np.arange(90, dtype=np.uint8)[:, None].repeat(5, axis=1)
            stats[:, 2] = stats[:, 1] * 2.0 ** np.arange(90)  # splits off a row at a time
        nodes = grown.grow_branch(x, stats, grown._Node(stats.sum(axis=0), 0, 0), 90, caps, 5)
        slow, fast = grown._tree(nodes, grown._chosen(nodes, caps)[0]), grown._cut(grown.grow_whole(x, stats, 0, 0, 90, caps, 5), caps)
        assert fast.n_leaves == slow.n_leaves and np.allclose(fast.predict(x), slow.predict(x))


def test_queries_run_at_the_original_settings(spark, monkeypatch):
    """They ran 500 of 10,000 trees, 20 of 500 and 10 of 50 rounds before."""
    asked = {}

    class Seen(Exception):
        pass

    def seen(name):
        def fit(df, keys, labels, **settings):
            asked[name] = settings
            raise Seen

        return fit

    monkeypatch.setattr(capped, "forest", seen("forest"))
    monkeypatch.setattr(capped, "adaboost", seen("adaboost"))
    rows = spark.range(3).select(F.lit(0).alias("data_set"), *(F.lit(1.0).alias(c) for c in dict.fromkeys([*grow.SPEC.hourly_features, *grow.SPEC.daily_features])))
    monkeypatch.setattr(grow, "_daily_rows", lambda *_: rows)
    monkeypatch.setattr(grow.fitted, "_inputs", lambda *_: rows)
    for query, name, settings in (
        (grow.joint_daily_forest, "forest", {"trees": 10_000, "caps": Caps(depth=20, share=0.2), "joint": True}),
        (grow.leaf_adaboost, "adaboost", {"rounds": 500, "rate": 0.01, "caps": Caps(leaves=128, split=8, leaf=4)}),
        (grow.leaf_bagged_adaboost, "adaboost", {"bags": 20, "sample": 0.7, "rounds": 50, "rate": 0.1, "caps": Caps(leaves=1024, split=8, leaf=4)}),
    ):
        with pytest.raises(Seen):
            query(spark, "")
        assert asked[name] == settings


def test_draws_of_members_are_those_of_jobs():
    rows = lanes.Rows(np.arange(500), np.zeros((1, 500), np.uint8), np.ones((500, 1)), np.ones(500), np.zeros(0, np.int64), np.zeros((0, 1), np.uint8))
    member = Member((0,), 0, 5, ("poisson", 1.0))
    (_, tree), = lanes.forest_trees(rows, [(3, member)], Caps(leaves=4), 1)
    assert tree.rows[0] == (grown.drawn(rows.rid, member) > 0).sum()


class _Seen(Exception):
    pass


def _estimators(monkeypatch, query, spark):
    """What a residual query fits to a label."""
    made = []

    def predict(inputs, spec, make):
        made.append(make("y"))
        raise _Seen

    monkeypatch.setattr(fitted.learn, "predict_residuals", predict)
    monkeypatch.setattr(fitted, "_inputs", lambda *_: None)
    with pytest.raises(_Seen):
        query(spark, "")
    return made[0]


def test_residual_queries_run_at_the_original_settings(spark, monkeypatch):
    """They ran 20 of 500 rounds, 5 of 20 bags of 10 of 50 rounds, and 30 of 500 rounds before, of trees of depth 4."""
    limits = {"maxDepth": None, "minSplit": 8, "minInstancesPerNode": 4}
    ada = _estimators(monkeypatch, fitted.residual_adaboost, spark)
    assert (ada.rounds, ada.rate, ada.tree_params) == (500, 0.01, limits | {"maxLeaves": 128})
    bags = _estimators(monkeypatch, fitted.residual_bagged_adaboost, spark)
    assert (bags.bags, bags.sample, bags.rounds, bags.rate, bags.tree_params) == (20, 0.7, 50, 0.1, limits | {"maxLeaves": 1024})
    gbt = _estimators(monkeypatch, fitted.residual_gbt, spark)
    assert gbt.how is capped.boosted and gbt.settings == {"rounds": 500, "rate": 0.01, "part": 0.7, "caps": Caps(leaves=100, depth=10)}


def test_adaboost_of_weighted_rows_has_its_leaf_cap(spark):
    df = rows_and_nulls(spark).withColumn("w", (F.col("c") % 3).cast("double"))
    model = AdaBoostR2("z", rounds=3, rate=0.5, weight="w", maxLeaves=6, maxDepth=None, minSplit=8, minInstancesPerNode=4).fit(df)
    assert [t.tree.n_leaves for t in model.trees] == [6, 6, 6] and all(t.tree.rows[t.tree.feature < 0].min() >= 4 for t in model.trees)
    assert model.trees[0].tree.rows[0] == df.where("w > 0").count()
    with pytest.raises(TypeError):
        AdaBoostR2("z", rounds=1, maxBins=4).fit(df)


def test_stacks_combine_whole_models(spark, monkeypatch):
    """They combined 10 trees of boosting, 10 of a forest and 2 bags of 6 rounds before; the stack had 20 of 1,000 trees."""
    gb, rf, ada = (fitted.BASES[name]("y") for name in ("gb", "rf", "ada"))
    assert gb.how is capped.boosted and gb.settings == capped.BOOSTED and gb.settings["rounds"] == 500
    assert rf.how is capped.forest and rf.settings == capped.FOREST and rf.settings["trees"] == 500
    assert (ada.bags, ada.rounds, ada.tree_params["maxLeaves"], ada.keys) == (20, 50, 1024, ["user_id", "ts"])
    made = []
    monkeypatch.setattr(fitted, "_tree_stack", lambda spark, sf_dir, make: made.append(make("y")))
    fitted.stack_forest(spark, "")
    assert made[0].how is capped.forest and made[0].settings == {"trees": 1000, "caps": Caps(leaves=2**14, depth=20, split=4, leaf=2)}


def test_a_row_is_scored_by_the_models_of_its_fold_only(spark):
    """All models of a label scored every row in one chain before."""
    from test_end_to_end import SPEC as spec

    seen = []

    class Model:
        def __init__(self, label, value):
            self.label, self.value = label, value

        def transform(self, df):
            seen.append((self.value, df.select("id").orderBy("id").collect()))
            return df.withColumn("prediction", F.lit(float(self.value)))

    class Fit:
        def __init__(self, label):
            self.label = label

        def fit(self, df):
            return Model(self.label, df.count())

    n, on = 12, [*spec.keys, spec.ts]
    rows = spark.range(n).select("id", *(F.col("id").cast("string").alias(c) for c in on), F.when(F.col("id") < 9, 0).otherwise(1).alias("data_set"))
    rows = rows.withColumns({c: F.lit(1.0) for c in spec.hourly_features} | {f"log_{s}_{e}": F.lit(2.0) for s in spec.segments for e in ("diff", "trend")})
    from seriesloom.plans import learn

    fold = F.when(F.col("id") % 4 == 3, F.lit(None)).otherwise((F.col("id") % 4 - 1).cast("int"))  # -1, 0, 1 and none
    out = learn.out_of_fold(rows, spec, Fit, fold, [0, 1], "m").select(*on, *(f"log_{s}_m_pred" for s in spec.segments))
    got = {int(r[0]): r[-1] for r in out.collect()}
    held = {0: [1, 5], 1: [2, 6]}
    expected = {i: 2.0 + (9 - len(held[0]) if i in held[0] else 9 - len(held[1]) if i in held[1] else 9) for i in range(n)}
    assert got == expected
    assert sorted(len(ids) for _, ids in seen) == sorted([8, 2, 2] * len(spec.segments))
